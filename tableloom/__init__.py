"""Analytics operators for Apache Spark: plain functions over DataFrames."""
