"""Ordered computations whose groups may be far larger than one task.

A plain window hands a whole group to one task, so a group holding a third of
a large table cannot finish. Here the sort order is cut at split points, as a
range partitioner does, each slice is numbered on its own, and the totals of
the earlier slices of the group are added. The split points come from a small
sample by hash; they only decide where slices begin, never which rows are
kept, so results are exact.

Orders are lists of column names, ``"-name"`` meaning descending. NULLs come
first ascending and last descending, as in Spark. An order must end in a
unique column where the result depends on the order of ties.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.scalar import bind
from tableloom.session import stored

SAMPLE_PER_SLICE = 16
BLOCK_ROWS = 65_536

_KEY, _POINTS, _PLACE, _SLICE = "__key", "__points", "__place", "__slice"


def _slices(df: DataFrame, slices: int | None) -> int:
    if slices is not None:
        return max(2, slices)
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _descending(df: DataFrame, name: str) -> list[Column]:
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.BooleanType):
        return [col.isNull(), ~col]
    if isinstance(kind, T.IntegralType):  # has no smallest value whose negative overflows
        return [col.isNull(), F.bitwise_not(col)]
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return [col.isNull(), ~F.isnan(col), -col]
    if isinstance(kind, T.DecimalType):
        return [col.isNull(), -col]
    if isinstance(kind, T.DateType):
        return [col.isNull(), F.bitwise_not(F.unix_date(col))]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [col.isNull(), F.bitwise_not(F.unix_micros(col.cast("timestamp")))]
    if isinstance(kind, (T.StringType, T.BinaryType)):
        # Bytes as hexadecimal digits, each turned round; the end sorts after all digits, so a longer text comes first.
        return [col.isNull(), F.concat(F.translate(F.hex(col), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))]
    raise ValueError(f"no descending order for {kind.simpleString()}: {name}")


def sort_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Column:
    """One struct that ascends in the order asked for, group keys first."""
    parts = [F.col(k) for k in keys]
    for name in order:
        parts += _descending(df, name[1:]) if name.startswith("-") else [F.col(name)]
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def _split_points(keyed: DataFrame, slices: int) -> Column:
    """Scalar subquery: sorted array of about ``slices`` keys.

    Keys are sampled by hash with a chance set from the row count, so about
    ``SAMPLE_PER_SLICE`` keys per slice are gathered whatever the table's
    size, and the same ones on every run. Equal keys collapse before that.
    """
    rows = keyed.agg(F.count(F.lit(1))).scalar()
    chance = F.try_divide(F.lit(float(slices * SAMPLE_PER_SLICE)), rows)
    sample = keyed.filter(F.pmod(F.xxhash64(_KEY), F.lit(1 << 40)) < chance * float(1 << 40)).select(_KEY).distinct()
    gathered = sample.agg(F.sort_array(F.collect_list(_KEY)).alias("s"))
    step = F.greatest(F.size("s") / F.lit(slices), F.lit(1.0))
    picked = F.filter("s", lambda _, i: F.floor((i + 1) / step) > F.floor(i / step))
    return gathered.select(picked.alias("p")).scalar()


def _place(slices: int) -> Column:
    """Struct of the row's slice and the split points on either side of its key.

    The slice is the number of split points at or below the key, found by
    binary search. The split points are bound once, so the sample is one
    subquery of the plan.
    """
    steps = F.array(*[F.lit(1 << b) for b in range(slices.bit_length(), -1, -1)])

    def search(both: Column) -> Column:
        points, key = both["points"], both["key"]

        def step(found: Column, width: Column) -> Column:
            inside = found + width <= F.size(points)
            below = F.get(points, found + width - 1) <= key
            return F.when(inside & below, found + width).otherwise(found)

        return bind(F.aggregate(steps, F.lit(0), step), lambda at: F.struct(
            at.alias("slice"), F.get(points, at - 1).alias("before"), F.get(points, at).alias("after")))

    return bind(F.struct(F.col(_POINTS).alias("points"), F.col(_KEY).alias("key")), search)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: dict[str, Column],
    slices: int | None = None,
    tops: dict[str, Column] | None = None,
) -> DataFrame:
    """Add inclusive running sums, and running maxima of ``tops``, of each expression within its group.

    Counting, sampling and totalling read only the key columns; the data
    is shuffled once, on (group, slice). Offsets are kept for groups that a
    split point falls into, hence at most two rows per split point, which is
    the proven bound that lets them be broadcast.
    """
    n = _slices(df, slices)
    keys, tops = list(keys), tops or {}
    folds = [*[(name, e, F.sum) for name, e in totals.items()], *[(name, e, F.max) for name, e in tops.items()]]
    keyed = df.withColumn(_KEY, sort_key(df, keys, order))
    pointed = keyed.withColumn(_POINTS, _split_points(keyed, n))
    cut = pointed.withColumn(_PLACE, _place(n)).drop(_POINTS).withColumn(_SLICE, F.col(f"{_PLACE}.slice"))

    def group_of(key: Column) -> Column:
        return F.struct(*[key[f"k{i}"].alias(f"k{i}") for i in range(len(keys))]) if keys else F.lit(True)

    # Split points are sorted by group first, so a group reaches over several slices
    # exactly when the split point before or after one of its rows belongs to it.
    group = group_of(F.col(_KEY))
    spans = group_of(F.col(f"{_PLACE}.before")).eqNullSafe(group) | group_of(F.col(f"{_PLACE}.after")).eqNullSafe(group)

    before = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.filter(spans)
        .groupBy(group.alias("g"), F.col(_SLICE).alias("b"))
        .agg(*[fold(e).alias(f"t{i}") for i, (_, e, fold) in enumerate(folds)])
        .select("g", "b", *[fold(f"t{i}").over(before).alias(f"o{i}") for i, (_, _, fold) in enumerate(folds)])
    )
    local = (
        Window.partitionBy(*keys, _SLICE).orderBy(_KEY)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = cut.drop(_PLACE).join(
        F.broadcast(offsets),
        group.eqNullSafe(F.col("g")) & (F.col(_SLICE) == F.col("b")),
        "left",
    )
    out = [
        (F.sum(expr).over(local) + F.coalesce(F.col(f"o{i}"), F.lit(0)) if fold is F.sum else F.greatest(F.max(expr).over(local), f"o{i}")).alias(name)
        for i, (name, expr, fold) in enumerate(folds)
    ]
    return placed.select(*df.columns, *out)


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, slices: int | None = None
) -> DataFrame:
    """ROW_NUMBER within each group, for groups of any size."""
    return running_totals(df, keys, order, {name: F.lit(1).cast("long")}, slices)


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    rank: str | None = None,
    dense: str | None = None,
    percent: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """RANK, DENSE_RANK and PERCENT_RANK of ``by`` (``"-col"`` descending).

    Ties are collapsed to one counted row before anything is ordered, so a
    value shared by a third of the table costs one row. The rank is joined
    back on (group, value). The counts are stored, as several passes read them.
    """
    col = by.lstrip("-")
    keys = list(keys)
    counts = stored(df.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("__n")), "value-counts")
    placed = running_totals(
        counts, keys, [by], {"__upto": F.col("__n"), "__dense": F.lit(1).cast("long")}, slices
    ).withColumn("__rank", F.col("__upto") - F.col("__n") + 1)
    if percent:
        size = counts.groupBy(*keys).agg(F.sum("__n").alias("__size"))
        placed = join_null_safe(placed, size, keys) if keys else placed.withColumn(
            "__size", counts.agg(F.sum("__n").alias("s")).scalar()
        )
    wanted = [f"`{c}` as `__j{i}`" for i, c in enumerate([*keys, col])]
    values = []
    if rank:
        values.append(F.col("__rank").alias(rank))
    if dense:
        values.append(F.col("__dense").alias(dense))
    if percent:
        values.append(
            F.when(F.col("__size") > 1, (F.col("__rank") - 1) / (F.col("__size") - 1))
            .otherwise(F.lit(0.0)).alias(percent)
        )
    lookup = placed.select(*[F.expr(w) for w in wanted], *values)
    on = [df[c].eqNullSafe(lookup[f"__j{i}"]) for i, c in enumerate([*keys, col])]
    return df.join(lookup, on).drop(*[f"__j{i}" for i in range(len(keys) + 1)])


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on same-named keys where NULL matches NULL; left keys are kept."""
    renamed = right.select(
        *[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)],
        *[c for c in right.columns if c not in keys],
    )
    on = [left[k].eqNullSafe(renamed[f"__r{i}"]) for i, k in enumerate(keys)]
    return left.join(renamed, on, how).drop(*[f"__r{i}" for i in range(len(keys))])


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    exprs: dict[str, Callable],
    back: int = 0,
    ahead: int = 0,
    block_rows: int = BLOCK_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Window expressions that look at most ``back``/``ahead`` rows away.

    Each expression is a function of a window spec. Rows are numbered, cut
    into blocks of ``block_rows``, and each block also receives the few rows
    next to its edges, so lag, lead and moving frames see their neighbours
    while no task gets more than one block of a group.
    """
    keys = list(keys)
    block_rows = max(block_rows, back + 1, ahead + 1)
    at = numbered(df, keys, order, "__rn", slices)
    pos, home = F.pmod(F.col("__rn") - 1, F.lit(block_rows)), F.floor((F.col("__rn") - 1) / block_rows)
    homes = F.array_compact(F.array(
        home,
        F.when(pos >= block_rows - back, home + 1),
        F.when(pos < ahead, home - 1),
    ))
    spread = at.withColumn("__home", home).withColumn("__block", F.explode(homes))
    w = Window.partitionBy(*keys, "__block").orderBy("__rn")
    computed = spread.select(
        *df.columns, "__home", "__block", *[make(w).alias(name) for name, make in exprs.items()]
    )
    return computed.filter(F.col("__home") == F.col("__block")).drop("__home", "__block")


def ntiles(df: DataFrame, n: int, order: Sequence[str], name: str, slices: int | None = None) -> DataFrame:
    """NTILE(n) over the whole table: the first ``count % n`` tiles get one row more."""
    total = df.agg(F.count(F.lit(1)).alias("c")).scalar()
    at = numbered(df, [], order, "__rn", slices).withColumn("__total", total)
    small = F.floor(F.col("__total") / n)
    extra = F.pmod(F.col("__total"), F.lit(n))
    edge = extra * (small + 1)
    tile = F.when(F.col("__rn") <= edge, F.floor((F.col("__rn") - 1) / (small + 1)) + 1).otherwise(
        extra + F.floor((F.col("__rn") - 1 - edge) / F.greatest(small, F.lit(1))) + 1
    )
    return at.select(*df.columns, tile.cast("int").alias(name))


def top_per_group(
    df: DataFrame, keys: Sequence[str], by: str, k: int, rank: str, null_rank: bool = True
) -> DataFrame:
    """Rows whose RANK of ``by`` within the group is at most ``k``, ties included.

    The ``k`` leading rows of a group come from a row-number limit that Spark
    also applies before its shuffle, so no task sees a whole group. They give
    the leading values and their ranks; joining on (group, value) then brings
    in every tied row.
    """
    col = by.lstrip("-")
    desc = by.startswith("-")
    keys = list(keys)
    edge = F.col(col).desc_nulls_last() if desc else F.col(col).asc_nulls_first()
    lead = (
        df.select(*keys, col)
        .withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(edge)))
        .filter(F.col("__rn") <= k)
        .groupBy(*keys, col)
        .agg(F.min("__rn").cast("long").alias(rank))
    )
    return join_null_safe(df, lead, [*keys, col])
