"""Joins, grouped aggregates and reports that need more than one DataFrame call."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.functions.scalar import bind
from tableloom.operators.ordered import join_null_safe, numbered, running_totals
from tableloom.session import stored

def join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hint: str | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join on same-named columns.

    ``hint`` names Spark's join strategy for the right side. Ask for
    ``"broadcast"`` only where the side has a bound of its own, such as a table
    of nations; without a hint Spark decides by size in bytes while it runs.
    """
    if hint is not None:
        right = right.hint(hint)
    if null_safe:
        return join_null_safe(left, right, on, how)
    return left.join(right, list(on), how)


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-NULL foreign key has no parent."""
    ref = parent.select(F.col(parent_column).alias("__pk"))
    return df.filter(F.col(column).isNotNull()).join(ref, F.col(column) == F.col("__pk"), "left_anti")


def pairs_within(df: DataFrame, group: str, unique: str, show: Sequence[str] = ()) -> DataFrame:
    """All pairs of rows of one group, unique1 < unique2; NULL groups and numbers pair with nothing.

    Meant for groups of bounded size, such as the lines of an order: the result
    has as many rows as all groups have pairs.
    """
    left = df.select(group, *[F.col(c).alias(f"{c}_1") for c in [unique, *show]])
    right = df.select(group, *[F.col(c).alias(f"{c}_2") for c in [unique, *show]])
    return left.join(right, group).filter(F.col(f"{unique}_1") < F.col(f"{unique}_2"))


def in_band(df: DataFrame, value: str, bands: DataFrame, width: float) -> DataFrame:
    """Each row with the band ``low <= value < low + width`` that holds it; rows outside all bands are left out.

    Bands start at multiples of ``width`` and thus don't overlap, so the range
    join is an equi-join on the band's number and keeps at most one match a row.
    ``bands`` has one row per band, with its start as ``low``.
    """
    number = lambda c: F.floor(F.col(c) / F.lit(width))
    numbered_bands = bands.withColumn("__band", number("low"))
    return df.withColumn("__band", number(value)).join(numbered_bands, "__band").drop("__band")


def in_ranges(df: DataFrame, value: str, ranges: DataFrame, low: str, high: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add how many ranges ``low <= value <= high`` of the same keys hold each row's value (``ranges_held``), and the largest ``high`` of these (``best_high``).

    Ranges may overlap in any number; no pair of a row and a range is built. Ends and
    values are swept in order: the ranges begun so far less those ended before the value hold it,
    and if any does, the largest ``high`` begun so far is the largest that holds it. Equal
    ends and equal values are one point each. A range with a NULL end or with
    ``low > high`` holds nothing; a NULL value is held by nothing; NULL keys match NULL keys.
    """
    keys = list(keys)
    valid = ranges.filter(F.col(low) <= F.col(high))

    def points(rows: DataFrame, at: str, kind: int, add: Column, top: Column) -> DataFrame:
        return rows.filter(F.col(at).isNotNull()).groupBy(*keys, F.col(at).alias("__at")).agg(
            F.lit(kind).alias("__kind"), add.cast("long").alias("__add"), top.alias("__top"))

    none = F.max(F.lit(None).cast(ranges.schema[high].dataType))
    count = F.count(F.lit(1))
    every = points(valid, low, 0, count, F.max(high)).unionByName(points(df, value, 1, F.lit(0), none)).unionByName(points(valid, high, 2, -count, none))
    swept = running_totals(stored(every, "range-points"), keys, ["__at", "__kind"], {"ranges_held": F.col("__add")}, tops={"__best": F.col("__top")})
    told = swept.filter("__kind = 1").select(*keys, F.col("__at").alias(value), "ranges_held", F.when(F.col("ranges_held") > 0, F.col("__best")).alias("best_high"))
    return join_null_safe(df, told, [*keys, value], "left").withColumn("ranges_held", F.coalesce("ranges_held", F.lit(0)))


def distinct_sketches(df: DataFrame, keys: Sequence[str], slice_by: str, column: str, log_size: int = 12) -> DataFrame:
    """One mergeable sketch of the column's different values per keys and slice, to be stored; a new slice is sketched alone."""
    return df.groupBy(*keys, slice_by).agg(F.hll_sketch_agg(column, F.lit(log_size)).alias("sketch"))


def sketched_counts(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Approximate number of different values per keys over any slices; standard error 1.04 / sqrt(2 ** log_size)."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"))


def cooccurrence(items: DataFrame, item_array: str, k: int | None = None) -> DataFrame:
    """How often two items share a row, from a column of distinct item arrays.

    Pairs are formed inside each row's own array, whose length is bounded by
    the dictionary it was drawn from, and counted with map-side combining.
    """
    def paired(found: Column) -> Column:
        return F.flatten(F.transform(found, lambda a, i: F.transform(
            F.slice(found, i + 2, F.size(found)), lambda b: F.struct(a.alias("item_1"), b.alias("item_2")))))

    pairs = bind(F.array_sort(F.array_distinct(item_array)), paired)
    counted = (
        items.select(F.explode(pairs).alias("p"))
        .groupBy(F.col("p.item_1").alias("item_1"), F.col("p.item_2").alias("item_2"))
        .agg(F.count(F.lit(1)).alias("co_occurrences"))
    )
    if k is None:
        return counted
    return counted.orderBy(F.desc("co_occurrences"), "item_1", "item_2").limit(k)


def group_agg(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def spread_or_zero(column: str, kind: str = "stddev") -> Column:
    """Sample standard deviation or variance, 0 for fewer than two values."""
    fn = F.stddev_samp if kind == "stddev" else F.var_samp
    return F.when(F.count(column) < 2, F.lit(0.0)).otherwise(fn(column))


def reduce_by_key(df: DataFrame, key: str, value: str, fold: Callable) -> DataFrame:
    """Fold the values of each key with a user function of two values.

    ``fold`` must be associative and commutative. Each task first folds what
    it reads, so a key contributes at most one value per task to the shuffle.
    """
    schema = df.select(key, value).schema

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for k, v in zip(batch[key], batch[value]):
                held[k] = fold(held[k], v) if k in held else v
            if len(held) > 100_000:
                yield pd.DataFrame({key: list(held), value: list(held.values())})
                held = {}
        if held:  # a table without rows has no types to convert
            yield pd.DataFrame({key: list(held), value: list(held.values())})

    def final(keys: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = None, False
        for batch in batches:
            for v in batch[value]:
                total, seen = (fold(total, v), True) if seen else (v, True)
        yield pd.DataFrame({key: [keys[0]], value: [total]})

    return df.select(key, value).mapInPandas(partial, schema).groupBy(key).applyInPandas(final, schema)


def collect_by_key(df: DataFrame, key: str, value: str, order: Sequence[str], chunk: int) -> DataFrame:
    """Values of each key as ordered lists, in chunks of at most ``chunk`` values.

    Nothing is dropped: a large group becomes several rows with rising
    ``chunk_no`` instead of one list that no task could hold.
    """
    at = numbered(df, [key], order, "__rn").withColumn(
        "chunk_no", F.floor((F.col("__rn") - 1) / F.lit(chunk))
    )
    pairs = F.sort_array(F.collect_list(F.struct("__rn", F.col(value).alias("v"))))
    return at.groupBy(key, "chunk_no").agg(F.transform(pairs, lambda p: p["v"]).alias("values"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column: count, mean, min, max."""
    return unpivot_stats(df, columns, {
        "n": lambda c: F.count(c),
        "mean": lambda c: F.avg(c),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    })


def unpivot_stats(df: DataFrame, columns: Iterable[str], stats: dict[str, Callable]) -> DataFrame:
    """Aggregate every column in one pass and return one row per column."""
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), *[make(c).alias(n) for n, make in stats.items()])
        for c in columns
    ])
    return df.agg(rows.alias("r")).select(F.inline("r"))


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts if k is None else counts.orderBy(F.desc("n"), column).limit(k)


def bucket(column: Column, edges: Sequence[float], labels: Sequence[str], right: bool = False) -> Column:
    """Label by edge: ``[lo, hi)`` buckets, or ``(lo, hi]`` when ``right``.

    ``labels`` has one more entry than ``edges``; NULL stays NULL.
    """
    out = F.when(column.isNull(), F.lit(None))
    for edge, label in zip(edges, labels):
        out = out.when(column <= edge if right else column < edge, label)
    return out.otherwise(labels[-1])


def corr_matrix(df: DataFrame, columns: Sequence[str], places: int = 3) -> DataFrame:
    """Pairwise correlations, all from one aggregation pass."""
    cells = F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                 (F.round(F.corr(a, b), places) + F.lit(0.0)).alias("corr"))
        for a in columns for b in columns
    ])
    return df.agg(cells.alias("r")).select(F.inline("r"))


def with_group_mean(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """Group mean beside each row, by aggregate and join rather than a window."""
    means = df.groupBy(key).agg(F.avg(column).alias(name))
    return join_null_safe(df, means, [key])


def funnel(df: DataFrame, stage: Column, name: str, position: Callable[[str], Column]) -> DataFrame:
    """Count, share and running count per stage, in the order ``position`` gives.

    The windows run over one row per stage, after the aggregation.
    """
    counts = df.groupBy(stage.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    upto = (
        Window.orderBy(position(name), name)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.select(
        name, "n",
        F.round(F.col("n") * 100.0 / F.sum("n").over(everything), 2).alias("percentage"),
        F.sum("n").over(upto).alias("cumulative"),
    )


def qualified_counts(
    have: DataFrame, need: DataFrame, item: str, person: str, level: str, required: str
) -> DataFrame:
    """Each requirement with the number of distinct people at or above its level.

    People are reduced to their best level per item and then to a count per
    (item, level), so a requirement meets a few rows instead of every person.
    """
    best = have.groupBy(item, person).agg(F.max(level).alias("__level"))
    levels = best.groupBy(item, "__level").agg(F.count(F.lit(1)).alias("__n"))
    met = F.sum(F.when(F.col("__level") >= F.col(required), F.col("__n")).otherwise(0))
    return (
        need.join(levels, item, "left")
        .groupBy(*need.columns).agg(F.coalesce(met, F.lit(0)).alias("qualified"))
    )
