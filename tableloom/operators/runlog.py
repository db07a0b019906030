"""Reports over logs of task runs and queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def success_rate(runs: DataFrame, now: str, hours: int = 24) -> DataFrame:
    """Percent of successful runs in the last hours before ``now``; 100 when there were none.

    ``now`` is an SQL expression or the name of a one-row subquery column.
    """
    recent = runs.filter(F.col("ts") > F.expr(now) - F.expr(f"INTERVAL {hours} HOURS"))
    rate = F.avg((F.col("status") == "success").cast("double")) * 100
    return recent.agg(F.coalesce(rate, F.lit(100.0)).alias("success_rate"))


def success_rate_at_end(runs: DataFrame, hours: int = 24) -> DataFrame:
    """Success rate of the hours before the newest run."""
    newest = runs.agg(F.max("ts")).scalar()
    return success_rate(runs.withColumn("__now", newest), "__now", hours)


def avg_duration(runs: DataFrame) -> DataFrame:
    return runs.groupBy("task_id").agg(F.avg("duration").alias("avg_duration"))


def sla_misses(runs: DataFrame, sla: float) -> DataFrame:
    return runs.filter(F.col("duration") > sla)


def recent_runs(runs: DataFrame, n: int, unique: str) -> DataFrame:
    return runs.orderBy(F.desc("ts"), F.desc(unique)).limit(n)


def query_report(log: DataFrame, label: str, elapsed: str) -> DataFrame:
    """Number of queries, total and mean time, slowest and fastest one."""
    total = F.sum(elapsed)
    return log.agg(
        F.count(F.lit(1)).alias("queries_run"), F.round(total, 4).alias("total_elapsed_s"),
        F.round(total / F.count(F.lit(1)) * 1000, 2).alias("avg_elapsed_ms"),
        F.max_by(label, F.struct(elapsed, label)).alias("slowest_query"),
        F.min_by(label, F.struct(elapsed, label)).alias("fastest_query"))
