"""Near-duplicate groups by HyperMinHash.

A text is the set of its distinct shingles. One hash per shingle fills 256
registers: eight bits choose the register, and the register keeps, of the least
remaining hash, the count of leading zeros and ten mantissa bits (two bytes in
all). Registers no shingle has reached take the value of another one by a fixed
order of search, so that short texts use all bands as well.

Equal sets are one class from the start. Classes that agree on all registers of
a band are candidates; the share of equal registers, corrected for the register
values that agree by chance, estimates their similarity. Classes joined by
chains of likely pairs form a family. Within families full shingle sets are
compared, and confirmed links are joined to components.

Neither step emits all pairs of a group: a bucket or family is cut into parts of
at most ``PART`` classes, each pair of parts is compared in one task, and only
links that join two so far separate groups there leave it. That loses no
component, since what is left out joins classes that are joined already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import LOWER, SPACED, hashes, mixed, pieces, runs, shingles, stored, text_bytes, unused
from tableloom.llm.graph import components

REGISTERS, MANTISSA = 256, 10
#: Classes of a part, and pairs that a task compares at once.
PART, PAIRS = 512, 1 << 18
#: Standard errors by which an estimate may fall short of the threshold.
SLACK = 5.0


@dataclass(frozen=True)
class Rule:
    """Shingle width, least similarity in percent, and registers per band."""

    width: int = 5
    percent: int = 80
    rows: int = 5

    @property
    def bands(self) -> int:
        return REGISTERS // self.rows

    @property
    def floor(self) -> float:
        """Least estimate of a pair that is worth confirming."""
        s = self.percent / 100
        return s - SLACK * (s * (1 - s) / REGISTERS) ** 0.5


#: At the threshold a pair is missed with a chance of (1 - s ** rows) ** bands: 2e-9 and 2e-9.
LOOSE, TIGHT = Rule(5, 80, 5), Rule(3, 85, 6)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and their rows. Fewer words than ``width`` are one shingle."""
    low = LOWER[data]
    start, end, row = runs(SPACED[low], offsets)
    words = hashes(low, start, end)
    whole, at = shingles(words, row, width)
    rows = row[at]
    counts = np.bincount(row, minlength=len(offsets) - 1)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.searchsorted(row, short)
        one = np.zeros(len(short), np.uint64)
        for i in range(width - 1):
            has = counts[short] > i
            one[has] = mixed(one[has] * np.uint64(31) + words[first[has] + i] + np.uint64(7))
        whole, rows = np.concatenate([whole, one]), np.concatenate([rows, short])
    order = np.lexsort((whole, rows))
    whole, rows = whole[order], rows[order]
    new = np.ones(len(whole), bool)
    new[1:] = (whole[1:] != whole[:-1]) | (rows[1:] != rows[:-1])
    return whole[new], rows[new]


def _row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    edge = np.searchsorted(rows, np.arange(n + 1))
    return total[edge[1:]] - total[edge[:-1]]


def set_names(whole: np.ndarray, rows: np.ndarray, n: int) -> list[bytes]:
    """A 16-byte name of each row's set: two sums of scrambled hashes."""
    parts = [_row_sums(mixed(whole ^ np.uint64(salt)), rows, n) for salt in (0x5BD1E995, 0x27D4EB2F165667C5)]
    raw = np.stack(parts, 1).astype(">u8").tobytes()
    return [raw[16 * i: 16 * i + 16] for i in range(n)]


EMPTY = np.uint16(0xFFFF)


@cache
def _search_order() -> np.ndarray:
    """[step][register]: where an empty register looks, in an order of its own that is the same for all texts."""
    rank = mixed(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(0x1000193)).reshape(REGISTERS, REGISTERS)
    return np.argsort(rank, axis=0)


def registers(whole: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """HyperMinHash registers [row][register]; empty ones filled from others."""
    out = np.full(n * REGISTERS, EMPTY, np.uint16)
    h = mixed(whole + np.uint64(0xD6E8FEB86659FD93))
    at = rows * REGISTERS + (h >> np.uint64(56)).astype(np.int64)
    rest = h << np.uint64(8) | np.uint64(0x80)
    # Leading zeros by the exponent of the top 52 bits, exact in a float.
    _, exponent = np.frexp((rest >> np.uint64(12)).astype(np.float64))
    zeros = np.minimum(52 - exponent, 62).astype(np.uint64)
    part = ((rest << zeros) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    # A smaller hash has more zeros, then a smaller mantissa: keep the least of the reversed count and the mantissa.
    value = ((np.uint64(62) - zeros) << np.uint64(MANTISSA) | part).astype(np.uint16)
    both = np.sort(at.astype(np.uint64) << np.uint64(16) | value)
    place = (both >> np.uint64(16)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    out[place[first]] = (both[first] & np.uint64(0xFFFF)).astype(np.uint16)
    out = out.reshape(n, REGISTERS)
    filled = out.copy()
    empty = np.argwhere((out == EMPTY) & (out != EMPTY).any(1, keepdims=True))
    for sources in _search_order():
        if not len(empty):
            break
        found = out[empty[:, 0], sources[empty[:, 1]]]
        done = found != EMPTY
        filled[empty[done, 0], empty[done, 1]] = found[done]
        empty = empty[~done]
    return filled


def similarity(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Collision-corrected estimates of the Jaccard similarity of pairs of register rows."""
    equal = (a == b).sum(1)
    ratio = sizes_a / np.maximum(sizes_b, 1)
    chance = 0.16992 * REGISTERS / (1 << MANTISSA) * 4 * ratio / np.square(1 + ratio)
    return np.maximum(equal - chance, 0) / REGISTERS


def _sketch_column(width: int) -> Callable[[pa.Array], pa.Array]:
    def sketch(text: pa.Array) -> pa.Array:
        data, offsets = text_bytes(text)
        names, sizes, kept = [], [], []
        for low, high in pieces(offsets):
            at, n = offsets[low: high + 1], high - low
            whole, rows = shingle_sets(data[at[0]: at[-1]], at - at[0], width)
            sizes.append(np.bincount(rows, minlength=n))
            names += set_names(whole, rows, n)
            raw = registers(whole, rows, n).tobytes()
            kept += [raw[2 * REGISTERS * i: 2 * REGISTERS * (i + 1)] for i in range(n)]
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(size, pa.int64()), pa.array(kept, pa.binary())], ["node", "n", "regs"])

    return sketch


def _set_column(width: int) -> Callable[[pa.Array], pa.Array]:
    def sets(text: pa.Array) -> pa.Array:
        data, offsets = text_bytes(text)
        names, kept = [], []
        for low, high in pieces(offsets):
            at, n = offsets[low: high + 1], high - low
            whole, rows = shingle_sets(data[at[0]: at[-1]], at - at[0], width)
            names += set_names(whole, rows, n)
            edge, raw = np.searchsorted(rows, np.arange(n + 1)), whole.tobytes()
            kept += [raw[8 * edge[i]: 8 * edge[i + 1]] for i in range(n)]
        return pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(kept, pa.binary())], ["node", "set"])

    return sets


class _Joined:
    """Groups of nodes joined so far."""

    def __init__(self) -> None:
        self.above: dict[bytes, bytes] = {}

    def root(self, x: bytes) -> bytes:
        while (up := self.above.get(x, x)) != x:
            self.above[x] = x = self.above.get(up, up)
        return x

    def join(self, a: bytes, b: bytes) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)
        return a != b


def _pairs_of(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j within consecutive groups of these sizes, at most about PAIRS at once."""
    start = np.concatenate([[0], np.cumsum(sizes)])
    todo = sizes * (sizes - 1) // 2
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(np.cumsum(todo[low:]), PAIRS, "right")) + low)
        ii, jj = [], []
        group = sizes[low:high]
        two = np.flatnonzero(group == 2)
        ii.append(start[low:high][two])
        jj.append(start[low:high][two] + 1)
        for g in np.flatnonzero(group > 2):
            i, j = np.triu_indices(group[g], 1)
            ii.append(i + start[low + g])
            jj.append(j + start[low + g])
        yield np.concatenate(ii), np.concatenate(jj)
        low = high


def _links(rule: Rule, confirm: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compare the classes of each group; rows of a group are adjacent and may span batches.

    Gives (a, b) for pairs that pass and join two groups that are separate so
    far in this task. With ``confirm``, full sets decide.
    """

    def compared(table: pa.Table) -> list[tuple[bytes, bytes]]:
        out, joined = [], _Joined()
        group = table.column("group").to_numpy()
        cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
        regs = np.frombuffer(b"".join(table.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        n, node = table.column("n").to_numpy(), table.column("node").to_pylist()
        side = table.column("side").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()] if confirm else None
        for i, j in _pairs_of(np.diff(cut)):
            # Two parts meet here once; pairs inside a part are compared where the part meets itself.
            apt = (side[i] != side[j]) | (side[i] == 2)
            small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            apt &= 100 * small >= rule.percent * large
            i, j = i[apt], j[apt]
            like = np.concatenate([similarity(regs[i[k: k + PAIRS // 8]], regs[j[k: k + PAIRS // 8]], n[i[k: k + PAIRS // 8]], n[j[k: k + PAIRS // 8]])
                                   for k in range(0, max(len(i), 1), PAIRS // 8)])
            good = np.flatnonzero(like >= rule.floor)
            for k in good[np.argsort(-like[good], kind="stable")]:
                a, b = node[i[k]], node[j[k]]
                if a == b or joined.root(a) == joined.root(b):
                    continue
                if confirm:
                    both = len(np.intersect1d(sets[i[k]], sets[j[k]], assume_unique=True))
                    if 100 * both < rule.percent * (n[i[k]] + n[j[k]] - both):
                        continue
                joined.join(a, b)
                out.append((a, b))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> pa.RecordBatch:
            found = compared(table)
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.binary()), pa.array([x[1] for x in found], pa.binary())], ["a", "b"])

        for batch in batches:
            for low in range(0, batch.num_rows, 2 * PART):
                part = batch.slice(low, 2 * PART)
                held.append(part)
                table = pa.Table.from_batches(held)
                group = table.column("group").to_numpy()
                # The last group may go on in the next rows.
                whole = int(np.flatnonzero(group == group[-1])[0])
                if whole:
                    yield flush(table.slice(0, whole))
                held = table.slice(whole).to_batches()
        if held and sum(b.num_rows for b in held):
            yield flush(pa.Table.from_batches(held))

    return run


def _compared(members: DataFrame, rule: Rule, confirm: bool) -> DataFrame:
    """Links among the rows (team, node, n, regs[, set]) of each team, in tasks of two parts at most."""
    sizes = members.groupBy("team").agg(F.count("*").alias("members")).filter(F.col("members") > 1)
    parts = F.ceil(F.col("members") / F.lit(PART)).cast("int")
    placed = members.join(sizes, "team").withColumn("parts", parts).withColumn(
        "part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("node"), F.col("parts"))).otherwise(0).cast("int"))
    # Part p meets every part q: the row goes to (min, max) of both, on side 0 or 1, or 2 where a part meets itself.
    meet = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("q")
    spread = placed.select("*", meet).select(
        F.xxhash64("team", F.least("part", "q"), F.greatest("part", "q")).alias("group"),
        F.when(F.col("part") == F.col("q"), 2).when(F.col("part") < F.col("q"), 0).otherwise(1).alias("side"),
        "node", "n", "regs", *(["set"] if confirm else []))
    return spread.repartition("group").sortWithinPartitions("group").mapInArrow(_links(rule, confirm), "a binary, b binary").distinct()


def sketches(docs: DataFrame, key: str, text: str, rule: Rule) -> DataFrame:
    """Per row: key, row_key, node (name of its shingle set), n (size) and regs."""
    made = F.arrow_udf(_sketch_column(rule.width), "node binary, n long, regs binary")(F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col(key).alias("key"), _row_key(key, text).alias("row_key"), made.alias("s")).select("key", "row_key", "s.*")


def _row_key(key: str, text: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.xxhash64(text))


def groups(docs: DataFrame, key: str, text: str, rule: Rule = LOOSE) -> DataFrame:
    """Per row of ``docs``: key, n_shingles, component_id (least key of the component), kept (key = component_id).

    A null or blank text has no shingles and is its own component. Repeated
    rows share a component and are all marked alike; ``deduplicated`` keeps one
    of them. Rows with a null key are told apart by their text and come after
    all keys; a component of such rows alone has a null id. An empty table gives
    no rows.
    """
    rows = _rooted(docs, key, text, rule)
    return rows.select(F.col("key").alias(key), F.col("n").alias("n_shingles"),
                       F.when(~F.col("head.none"), F.col("head.row_key")).alias("component_id"), "kept")


def _rooted(docs: DataFrame, key: str, text: str, rule: Rule) -> DataFrame:
    """Per row: key, row_key, n, head (the component's first row_key) and kept."""
    rows = stored(sketches(docs, key, text, rule), "sketches")
    own = F.struct(F.col("key").isNull().alias("none"), F.col("row_key"))
    classes = stored(rows.filter(F.col("n") > 0).groupBy("node").agg(
        F.min(own).alias("head"), F.max("n").alias("n"), F.max("regs").alias("regs")), "classes")
    size = 2 * rule.rows
    bands = F.transform(F.sequence(F.lit(0), F.lit(rule.bands - 1)), lambda i: F.xxhash64(i, F.substring("regs", i * size + 1, F.lit(size))))
    banded = classes.select("node", F.explode(bands).alias("team"))
    shared = banded.groupBy("team").agg(F.count("*").alias("c")).filter(F.col("c") > 1).select("team")
    buckets = banded.join(shared, "team")
    members = stored(buckets.join(classes.select("node", "n", "regs"), "node"), "buckets")
    likely = components(_compared(members, rule, confirm=False))
    family = likely.select("node", F.xxhash64("root").alias("team"))
    wanted = stored(classes.join(family, "node").select("node", "team", "n", "regs", F.col("head.row_key").alias("row_key")), "families")
    # Full sets of the families' classes, from one row of each.
    texts = docs.select(_row_key(key, text).alias("row_key"), F.col(text).alias("text")).join(
        wanted.select("row_key").distinct().hint("merge"), "row_key", "left_semi")  # grows with the corpus: never broadcast
    made = F.arrow_udf(_set_column(rule.width), "node binary, set binary")(F.coalesce(F.col("text"), F.lit("")))
    sets = stored(texts.select(made.alias("s")).select("s.*"), "sets").groupBy("node").agg(F.max("set").alias("set"))
    linked = components(_compared(wanted.join(sets, "node"), rule, confirm=True))
    rooted = classes.select("node", "head").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = rooted.groupBy("root").agg(F.min("head").alias("head"))
    found = rooted.select("node", "root").join(heads, "root").select("node", "head")
    return rows.drop("regs").join(found, "node", "left").withColumn("head", F.coalesce("head", own)).withColumn("kept", F.col("head") == own)


def deduplicated(docs: DataFrame, key: str, text: str, rule: Rule = LOOSE) -> DataFrame:
    """One row of each component, with all columns of ``docs``: a row of its least key.

    Rows of one key are one document, whose rows beyond the first met go as well.
    Rows without shingles stay, one for each key.
    """
    name = unused(docs, "__row_key")
    kept = _rooted(docs, key, text, rule).filter("kept").select(F.col("row_key").alias(name)).distinct()
    return docs.withColumn(name, _row_key(key, text)).join(kept, name, "left_semi").dropDuplicates([name]).drop(name)
