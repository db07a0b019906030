"""Log-topic operations on tables of keyed records: routing, offsets, lag, reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.scalar import md5_partition
from tableloom.operators.ordered import numbered

PARTITIONS = 6
# Partitions that serve an event priority or a region; others may use any.
PRIORITY_ROUTES = {"critical": [0], "high_priority": [1, 2], "normal": [3, 4], "low_priority": [5]}
REGION_ROUTES = {"north_america": [0, 1], "europe": [2, 3], "asia": [4, 5]}


def by_key(key: str, n: int = PARTITIONS) -> Column:
    return md5_partition(F.col(key), n)


def by_route(route: str, key: str, routes: dict[str, list[int]], n: int = PARTITIONS) -> Column:
    """One of the partitions of the row's route, chosen by key hash."""
    def choose(allowed: Sequence[int]) -> Column:
        return F.get(F.array(*[F.lit(p) for p in allowed]), md5_partition(F.col(key), len(allowed)))

    out = F.when(F.lit(False), F.lit(None).cast("int"))
    for name, allowed in routes.items():
        out = out.when(F.col(route) == name, choose(allowed))
    return out.otherwise(choose(range(n)))


def round_robin(df: DataFrame, order: Sequence[str], n: int = PARTITIONS, name: str = "partition") -> DataFrame:
    """Partitions dealt out in row order."""
    at = numbered(df, [], order, "__rn")
    return at.withColumn(name, F.pmod(F.col("__rn") - 1, F.lit(n)).cast("int")).drop("__rn")


def assign_partition(df: DataFrame, how: str, key: str | None = None, route: str | None = None,
                     order: Sequence[str] = (), n: int = PARTITIONS) -> DataFrame:
    """Add ``partition`` by ``hash``, ``round_robin``, ``priority`` or ``region``."""
    if how == "round_robin":
        return round_robin(df, order, n)
    if how == "hash":
        return df.withColumn("partition", by_key(key, n))
    routes = {"priority": PRIORITY_ROUTES, "region": REGION_ROUTES}[how]
    return df.withColumn("partition", by_route(route, key, routes, n))


def with_offset(df: DataFrame, order: Sequence[str], partition: str = "partition") -> DataFrame:
    """Offset 0, 1, ... within each partition."""
    at = numbered(df, [partition], order, "__rn")
    return at.withColumn("offset", F.col("__rn") - 1).drop("__rn")


def committed(history: DataFrame) -> DataFrame:
    """Last committed offset per group and partition."""
    return history.groupBy("group_id", "partition").agg(F.max_by("offset", "ts").alias("committed"))


def lag(log: DataFrame, commits: DataFrame) -> DataFrame:
    """Records each partition holds beyond the committed offset (0 where nothing is committed)."""
    ends = log.groupBy("partition").agg((F.max("offset") + 1).alias("latest"))
    return ends.join(commits.select("partition", "committed"), "partition", "left").select(
        "partition", "latest", (F.col("latest") - F.coalesce("committed", F.lit(0))).alias("lag"))


def read_from(log: DataFrame, offsets: DataFrame, n: int) -> DataFrame:
    """Up to ``n`` records per partition from the given offset (0 where none is given).

    Offsets are dense, so the limit is a range of offsets and needs no sort.
    """
    start = F.coalesce("start", F.lit(0))
    joined = log.join(offsets.select("partition", F.col("committed").alias("start")), "partition", "left")
    return joined.filter((F.col("offset") >= start) & (F.col("offset") < start + n)).drop("start")
