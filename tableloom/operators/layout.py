"""Partitioning, caching and skew: how rows are spread over tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.scalar import md5_partition


def salted_agg(df: DataFrame, keys: Sequence[str], unique: str, aggs: dict[str, tuple[Callable, str, Callable]], salts: int = 16) -> DataFrame:
    """Aggregate a skewed key in two steps over ``salts`` sub-groups.

    ``aggs`` maps a name to (first step, column, second step). The salt comes
    from the row's own key, so a repeated task gives the same sub-groups.
    """
    salt = F.pmod(F.xxhash64(unique), F.lit(salts)).alias("__salt")
    first = df.groupBy(*keys, salt).agg(*[f(c).alias(n) for n, (f, c, _) in aggs.items()])
    return first.groupBy(*keys).agg(*[g(n).alias(n) for n, (_, _, g) in aggs.items()])


def hash_partition(column: str, n: int) -> Column:
    return md5_partition(F.col(column), n)


def range_partition(df: DataFrame, column: str, n: int) -> Column:
    """Equal-width ranges between the smallest and the largest value."""
    s = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    width = (s.getField("hi") - s.getField("lo")) / n
    return F.coalesce(F.least(F.floor(F.try_divide(F.col(column) - s.getField("lo"), width)), F.lit(n - 1)), F.lit(0)).cast("int")


def partition_sizes(df: DataFrame, part: Column) -> DataFrame:
    """Rows per partition number or partition value."""
    return df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))


def task_sizes(df: DataFrame) -> DataFrame:
    """Rows per physical partition, as the plan happens to spread them."""
    return df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("rows"))


def spread(df: DataFrame, how: str, columns: Sequence[str], n: int) -> DataFrame:
    """Repartition by ``hash`` or ``range`` of the columns."""
    return df.repartition(n, *columns) if how == "hash" else df.repartitionByRange(n, *columns)


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """The table kept at a storage level within the block; lost blocks are recomputed."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def scalar_function(fn: Callable[..., pd.Series], returns: T.DataType | str):
    """A user function over whole columns, run on Arrow batches."""
    return F.pandas_udf(fn, returns)
