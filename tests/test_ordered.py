"""Sliced ordered operators against plain windows: hot groups, ties, NULLs."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tableloom.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, many ties, some NULL keys and values."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 41 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 17))
    value = F.when(F.col("id") % 19 == 0, None).otherwise((F.col("id") * 7919 % 101).cast("double"))
    return spark.range(3000).select("id", key.alias("k"), value.alias("v"))


def same(a, b):
    assert a.columns == b.columns
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("order", [["v", "id"], ["-v", "id"]])
@pytest.mark.parametrize("slices", [2, 7, 64])
def test_numbered(skewed, keys, order, slices):
    first = F.desc("v") if order[0] == "-v" else F.asc("v")
    w = Window.partitionBy(*keys).orderBy(first, "id")
    plain = skewed.withColumn("rn", F.row_number().over(w).cast("long"))
    same(ordered.numbered(skewed, keys, order, "rn", slices), plain)


def test_running_totals(skewed):
    w = Window.partitionBy("k").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumn("t", F.sum("id").over(w))
    same(ordered.running_totals(skewed, ["k"], ["v", "id"], {"t": F.col("id")}, 16), plain)


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("by", ["v", "-v"])
def test_ranked(skewed, keys, by):
    first = F.desc("v") if by == "-v" else F.asc("v")
    w = Window.partitionBy(*keys).orderBy(first)
    plain = skewed.select(
        "*", F.rank().over(w).cast("long").alias("r"), F.dense_rank().over(w).cast("long").alias("d"),
        F.percent_rank().over(w).alias("p"))
    same(ordered.ranked(skewed, keys, by, "r", "d", "p", slices=5), plain)


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("block_rows", [5, 64, 100_000])
def test_with_neighbours(skewed, keys, block_rows):
    w = Window.partitionBy(*keys).orderBy("v", "id")
    exprs = {
        "back": lambda x: F.lag("id", 2).over(x), "next": lambda x: F.lead("id").over(x),
        "mean": lambda x: F.avg("id").over(x.rowsBetween(-4, 0)),
    }
    plain = skewed.select("*", *[e(w).alias(n) for n, e in exprs.items()])
    got = ordered.with_neighbours(skewed, keys, ["v", "id"], exprs, back=4, ahead=1, block_rows=block_rows, slices=6)
    same(got, plain)


@pytest.mark.parametrize("rows,n", [(10, 4), (3, 4), (1000, 7)])
def test_ntiles(spark, rows, n):
    df = spark.range(rows).select(F.col("id"), (-F.col("id")).alias("x"))
    plain = df.withColumn("tile", F.ntile(n).over(Window.orderBy("x")))
    same(ordered.ntiles(df, n, ["x"], "tile", 4), plain)


@pytest.mark.parametrize("by", ["v", "-v"])
def test_top_per_group_keeps_ties(skewed, by):
    first = F.desc("v") if by == "-v" else F.asc("v")
    w = Window.partitionBy("k").orderBy(first)
    plain = skewed.withColumn("rk", F.rank().over(w).cast("long")).filter("rk <= 3")
    same(ordered.top_per_group(skewed, ["k"], by, 3, "rk"), plain)


def test_descending_values_of_all_kinds(spark):
    rows = [("a", -(2**63), True, float("nan")), ("ab", 2**63 - 1, False, 1.0), ("", 0, None, float("inf")), ("b", -1, True, -0.5), (None, None, False, None),
            ("é", 1, True, 2.0), ("z", 2, False, float("-inf")), ("日", 3, None, 0.5)]
    df = spark.createDataFrame(rows, "s string, n long, f boolean, x double")
    for order in (["-s"], ["-n"], ["-f", "-s"], ["-x"]):
        w = Window.orderBy(*[F.desc_nulls_last(c[1:]) for c in order])
        same(ordered.numbered(df, [], order, "rn", 3), df.withColumn("rn", F.row_number().over(w).cast("long")))
    with pytest.raises(ValueError):
        ordered.numbered(spark.createDataFrame([([1],)], "a array<int>"), [], ["-a"], "rn")


def test_descending_times(spark):
    df = spark.sql("SELECT id, timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 977 % 1009 / 7) AS ts FROM range(500)")
    w = Window.orderBy(F.desc("ts"), "id")
    same(ordered.numbered(df, [], ["-ts", "id"], "rn", 9), df.withColumn("rn", F.row_number().over(w).cast("long")))


def test_only_small_data_is_broadcast(skewed):
    plan = ordered.numbered(skewed, ["k"], ["v", "id"], "rn", 8)._jdf.queryExecution().executedPlan().toString()
    # The data is shuffled once, by group and slice; what is broadcast is the offsets.
    assert plan.count("BroadcastExchange") == 1
