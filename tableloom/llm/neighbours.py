"""Approximate nearest neighbours on shifted space-filling curves.

Every vector is projected by several random rotations, each with a shift of its own, and
put on the Hilbert curve of the projected space; near vectors tend to be near on some of
the curves. All vectors are ranked along each curve by range partitions, and a query
looks at the window of ranks around its own on every curve. Windows are made of blocks
of ``BLOCK`` ranks, so a task's memory is bounded; what they find is merged, with exact
distances on the original vectors.

How far a window reaches is measured, not set: the true neighbours of a bounded sample
of queries are found by one scan of all vectors, and the reach is the least that would
have caught ``CAUGHT`` of them on some curve. Where the vectors have structure windows
are short; where they have none, as random directions, they grow with the table, since
nothing shorter would find the neighbours.

Equal vectors are one class, which carries its smallest ids, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import stored
from tableloom.operators.ordered import numbered

CURVES, AXES, AXIS_BITS = 4, 8, 7
BLOCK = 4096
#: Vectors that scale the projections, queries whose true neighbours set the windows, and the share to catch.
FITTED, MEASURED, CAUGHT = 1024, 192, 0.97
#: Queries compared with a block at once.
QUERIES = 256


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (rows of integer cells under ``2 ** bits`` per axis)."""
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    # From the highest bit down, turn each subcube so that its curve begins where the one before ended.
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for a in range(axes):
            inside = x[a] & q != 0
            swap = np.where(inside, 0, (x[0] ^ x[a]) & (q - 1))
            x[0] ^= np.where(inside, q - 1, swap)
            x[a] ^= swap
    for a in range(1, axes):
        x[a] ^= x[a - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[-1] & q != 0, q - 1, 0)
    x ^= turn
    place = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for a in range(axes):
            place = place << 1 | (x[a] >> b & 1)
    return place


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists are equally long."""
    flat = column.flatten()
    return np.asarray(flat, dtype=np.float64).reshape(len(column), -1)


def _axes(dim: int, curve: int) -> tuple[np.ndarray, np.ndarray]:
    """Projection and shift of a curve, the same everywhere."""
    r = np.random.default_rng([20240229, dim, curve])
    return r.standard_normal((dim, AXES)) / np.sqrt(dim), r.uniform(-0.5, 0.5, AXES)


def _fit(sample: list[np.ndarray], curves: int) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Mean and spread of the sampled projections, for each length of vectors and curve."""
    out = {}
    for dim in {len(v) for v in sample}:
        x = np.array([v for v in sample if len(v) == dim])
        for c in range(curves):
            with np.errstate(over="ignore", invalid="ignore"):
                p = x @ _axes(dim, c)[0]
                out[dim, c] = np.nan_to_num(p.mean(0)), np.nan_to_num(p.std(0))
    return out


def _keys(fit, curves: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, column = np.asarray(batch.column("dim")), batch.column("v")
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                rows = batch.take(pa.array(at))
                x = _matrix(rows.column("v"))
                for c in range(curves):
                    turn, shift = _axes(int(dim), c)
                    mean, spread = fit.get((int(dim), c), (np.zeros(AXES), np.ones(AXES)))
                    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                        unit = np.nan_to_num((x @ turn - mean) / np.where(spread > 0, spread, 1))
                    cell = np.clip(np.floor((np.clip(unit, -8, 8) + shift) * 2 ** (AXIS_BITS - 3)) + 2 ** (AXIS_BITS - 1), 0, 2 ** AXIS_BITS - 1)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("dim"), pa.array(np.full(len(at), c, np.int32)), pa.array(hilbert(cell, AXIS_BITS)), rows.column("h"), rows.column("id"), rows.column("asks")],
                        ["dim", "curve", "place", "h", "id", "asks"])

    return run


def _nearest_rows(queries: np.ndarray, vectors: np.ndarray, first: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the rows of its ``k`` nearest vectors by distance, then by ``first``, and these distances.

    Products pick the rows that may be nearest, with room for their rounding; distances are those of the differences.
    """
    with np.errstate(over="ignore"):
        squares = (vectors ** 2).sum(1)
    for low in range(0, len(queries), QUERIES):
        part = queries[low: low + QUERIES]
        with np.errstate(over="ignore", invalid="ignore"):
            own = (part ** 2).sum(1)
            rough = own[:, None] + squares[None] - 2 * (part @ vectors.T)
        for i in range(len(part)):
            row = rough[i]
            if len(row) > k and np.isfinite(row).all():
                limit = np.partition(row, k - 1)[k - 1]
                at = np.flatnonzero(row <= limit + 1e-12 * (own[i] + squares.max()) * vectors.shape[1])
            else:
                at = np.arange(len(row))
            with np.errstate(over="ignore"):
                d = np.sqrt(((vectors[at] - part[i]) ** 2).sum(1))
            best = np.lexsort((first[at], d))[:k]
            yield low + i, at[best], d[best]


def _true(sample: list[tuple[int, int, np.ndarray]], k: int):
    """Nearest vectors of the sampled queries within a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims):
                own = [s for s in sample if len(s[2]) == dim]
                if not own:
                    continue
                rows = batch.take(pa.array(np.flatnonzero(dims == dim)))
                x, h, ids = _matrix(rows.column("v")), np.asarray(rows.column("h")), np.asarray(rows.column("id"))
                for i, at, d in _nearest_rows(np.array([s[2] for s in own]), x, ids, k):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), own[i][j], np.int64)) for j in (0, 1)] + [pa.array(h[at]), pa.array(ids[at]), pa.array(d)],
                                                     ["qh", "qid", "h", "id", "d"])

    return run


def _searched(k: int):
    """Rows of a block, sorted so that its vectors come before its queries: the block is held, queries stream past it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, seen = None, [], None
        for batch in batches:
            cell = np.stack([np.asarray(batch.column(c)) for c in ("dim", "curve", "block", "asks")], axis=1).astype(np.int64)
            cuts = np.flatnonzero((cell[1:] != cell[:-1]).any(1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(cell)]):
                if low == high:
                    continue
                part, here, asks = batch.slice(low, high - low), tuple(cell[low, :3]), bool(cell[low, 3])
                if here != last:
                    last, held, seen = here, [], None
                if not asks:
                    held.append(part)
                    continue
                if not held:
                    continue
                if seen is None:
                    table = pa.Table.from_batches(held).combine_chunks()
                    seen = _matrix(table.column("v").combine_chunks()), np.asarray(table.column("id")), table.column("ids").combine_chunks()
                x, first, ids = seen
                found = list(_nearest_rows(_matrix(part.column("v")), x, first, k))
                owner = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
                at = np.concatenate([f[1] for f in found])
                yield pa.RecordBatch.from_arrays([part.column("h").take(pa.array(owner)), part.column("id").take(pa.array(owner)), ids.take(pa.array(at)), pa.array(np.concatenate([f[2] for f in found]))],
                                                 ["h", "id", "ids", "d"])

    return run


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(rows: DataFrame, key: str, vector: str, queries: Column, k: int = 10, curves: int = CURVES, block: int = BLOCK) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` nearest other rows found for each row that meets ``queries``.

    Nearness is the smallest Euclidean distance, ties go to the smaller id; all candidates
    are returned if there are fewer than ``k``. Rows without an id and vectors that aren't
    ``usable`` take no part; vectors are compared with vectors of as many components; a row
    repeated with the same vector counts once, and a query never meets its own id. An empty
    table gives no rows; other columns are not read.
    """
    asks = F.coalesce(queries, F.lit(False))
    base = rows.filter(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), asks.alias("asks"))
    base = base.withColumn("h", F.xxhash64("v")).dropDuplicates(["h", "id", "v"])
    leading = F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))
    classes = base.select("h", "v", "id", leading.alias("i")).filter(F.col("i") <= k + 1).groupBy("h", "v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    asking = base.filter("asks").groupBy("h", "v").agg(F.min("id").alias("id"))
    points = stored(
        classes.select("h", F.col("ids")[0].alias("id"), "ids", "v", F.lit(False).alias("asks"))
        .unionByName(asking.select("h", "id", F.array("id").alias("ids"), "v", F.lit(True).alias("asks")))
        .withColumn("dim", F.size("v")), "points")
    vectors, asked = points.filter("not asks"), points.filter("asks")

    by_hash = [F.xxhash64("h", F.lit(1)), "h", "id"]
    sample = [np.array(r.v, np.float64) for r in vectors.orderBy(*by_hash).select("v").limit(FITTED).collect()]
    measured = [(r.h, r.id, np.array(r.v, np.float64)) for r in asked.orderBy(*by_hash).select("h", "id", "v").limit(MEASURED).collect()]
    placed = stored(points.select("dim", "h", "id", "asks", "v").mapInArrow(
        _keys(_fit(sample, curves), curves), "dim int, curve int, place long, h long, id long, asks boolean"), "places")
    ranks = stored(numbered(placed, ["dim", "curve"], ["place", "h", "id", "asks"], "rank"), "ranks")

    spread = _reach(vectors, ranks, measured, k)
    cell = lambda at: F.floor(at / F.lit(block)).cast("long")
    full = ranks.join(spread, "dim", "left")
    blocks = F.when(F.col("asks"), F.sequence(cell(F.greatest(F.col("rank") - F.col("reach"), F.lit(0))), cell(F.least(F.col("rank") + F.col("reach"), F.col("rows")))))
    there = full.select("dim", "curve", "h", "id", "asks", F.explode(F.coalesce(blocks, F.array(cell(F.col("rank"))))).alias("block"))
    cells = there.join(points.drop("dim"), ["h", "id", "asks"]).select("dim", "curve", "block", "asks", "h", "id", "ids", "v")
    sorted_cells = cells.repartition("dim", "curve", "block").sortWithinPartitions("dim", "curve", "block", "asks")
    found = sorted_cells.mapInArrow(_searched(k + 1), "h long, id long, ids array<long>, d double")

    merged = found.select("h", "id", F.explode("ids").alias("vec_id"), "d").groupBy("h", "id", "vec_id").agg(F.min("d").alias("score"))
    first = F.row_number().over(Window.partitionBy("h", "id").orderBy("score", "vec_id"))
    best = merged.withColumn("i", first).filter(F.col("i") <= k + 1).groupBy("h", "id").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("best"))
    # Back from classes of equal queries to the queries, each without itself.
    answer = asked.join(best, ["h", "id"]).select("h", "v", "best")
    own = base.filter("asks").select("h", "v", F.col("id").alias("query_id")).join(answer, ["h", "v"])
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(others).alias("rank", "b")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))


def _reach(vectors: DataFrame, ranks: DataFrame, measured: list[tuple[int, int, np.ndarray]], k: int) -> DataFrame:
    """Rows (dim, rows, reach): how far windows go on either side; a length of vectors without a measured query is searched whole."""
    found = vectors.select("dim", "h", "id", "v").mapInArrow(_true(measured, k + 1), "qh long, qid long, h long, id long, d double")
    near = Window.partitionBy("qh", "qid").orderBy("d", "id")
    true = stored(found.withColumn("i", F.row_number().over(near)).filter(F.col("i") <= k + 1).drop("i", "d"), "true")
    theirs = ranks.filter("not asks").select("dim", "curve", "h", "id", F.col("rank").alias("there"))
    asked = ranks.filter("asks").select("dim", "curve", F.col("h").alias("qh"), F.col("id").alias("qid"), F.col("rank").alias("here"))
    # At most MEASURED * (k + 1) rows, which the other side meets.
    gaps = theirs.join(F.broadcast(true), ["h", "id"]).join(asked, ["dim", "curve", "qh", "qid"])
    least = gaps.groupBy("dim", "qh", "qid", "h", "id").agg(F.min(F.abs(F.col("here") - F.col("there"))).alias("gap"))
    reach = least.groupBy("dim").agg(F.ceil(F.percentile("gap", F.lit(CAUGHT))).alias("reach"))
    rows = ranks.groupBy("dim").agg(F.max("rank").alias("rows"))
    return stored(rows.join(reach, "dim", "left").select("dim", "rows", F.coalesce("reach", "rows").cast("long").alias("reach")), "reach")
