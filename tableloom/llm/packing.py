"""Packing documents into sequences, shortest pack first over the length histogram.

A document's ids are cut into pieces of at most a sequence; only its last piece
can be shorter. The histogram of piece lengths, at most ``SEQUENCE`` numbers, is
all that the plan needs: from the longest length down, all pieces of a length go
to the packs with the most room, many packs of one pattern at a time, or open new
packs. A pattern says which lengths share a sequence and how often.

Pieces find their place by rank: the n-th piece of a length takes the n-th place
that the patterns hold for it. Ranks come from counts per length and bucket, so
a length that most pieces have is numbered in many tasks.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import stored
from tableloom.llm.tokens import token_ids

SEQUENCE = 2048
#: Rows of a length that one task numbers, about.
BUCKET_ROWS, SLOTS = 250_000, 1 << 14


@dataclass
class Places:
    """Places per length, sorted by (length, first rank). ``packs`` sequences from ``base`` on share a pattern, which
    holds the length ``times`` times from ``offset`` on."""

    length: np.ndarray
    rank: np.ndarray
    packs: np.ndarray
    base: np.ndarray
    offset: np.ndarray


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> Places:
    """Shortest-pack-first packing of pieces of each length."""
    # Open packs by room left: (packs, pattern as (length, times) runs). The largest room is served first.
    room: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = defaultdict(list)
    largest: list[int] = []

    def put(left: int, packs: int, pattern: tuple[tuple[int, int], ...]) -> None:
        if not room[left]:
            heappush(largest, -left)
        room[left].append((packs, pattern))

    for length in sorted(histogram, reverse=True):
        todo = histogram[length]
        while todo:
            while largest and not room[-largest[0]]:
                heappop(largest)
            left = -largest[0] if largest else 0
            if left < length:
                put(sequence - length, todo, ((length, 1),))
                break
            packs, pattern = room[left].pop()
            used = min(packs, todo)
            if packs > used:
                put(left, packs - used, pattern)
            last, times = pattern[-1]
            longer = (*pattern[:-1], (last, times + 1)) if last == length else (*pattern, (length, 1))
            put(left - length, used, longer)
            todo -= used
    rows, base = [], 0
    for left in sorted(room):
        for packs, pattern in room[left]:
            at = 0
            for length, times in pattern:
                rows.append((length, packs, times, base, at))
                at += length * times
            base += packs
    rows.sort()
    length, packs, times, first, at = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 5
    taken = np.cumsum(packs * times) - packs * times
    start = np.searchsorted(length, length)
    return Places(length, taken - (taken[start] if len(taken) else taken), packs, first, at)


def _place(places: Places):
    """Column function from (length, rank) to (sequence_id, offset). The patterns number less than two per length."""
    # Lengths are below 2 ** 22, ranks below 2 ** 41.
    keys = places.length << 41 | places.rank

    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        size, n = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        at = np.searchsorted(keys, size << 41 | n, "right") - 1
        within = n - places.rank[at]
        return pa.StructArray.from_arrays(
            [pa.array(places.base[at] + within % places.packs[at]), pa.array(places.offset[at] + within // places.packs[at] * size)],
            ["sequence_id", "offset"])

    return F.arrow_udf(place, "sequence_id long, offset long")


def pieces(docs: DataFrame, key: str, text: str, tokenizer: str, end: int = 1, sequence: int = SEQUENCE) -> DataFrame:
    """Per piece: piece (a number of its own), key, start, length, ids (little-endian unsigned 32-bit), doc_tokens.

    Stored once, as later steps read it twice.

    A null or empty text is the end id alone. Repeated rows have pieces each. A null key stays null.
    """
    made = docs.select(F.col(key).alias(key), token_ids(F.col(text), tokenizer, end).alias("all"))
    tokens = (F.octet_length("all") / 4).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.col("doc_tokens") - 1, F.lit(sequence).cast("long"))
    cut = made.withColumn("doc_tokens", tokens).select(key, "doc_tokens", "all", F.explode(starts).alias("start"))
    part = F.substring("all", (F.col("start") * 4 + 1).cast("int"), F.lit(4 * sequence))
    out = cut.select(key, "start", part.alias("ids"), "doc_tokens")
    return stored(out.select(F.monotonically_increasing_id().alias("piece"), key, "start", (F.octet_length("ids") / 4).cast("long").alias("length"), "ids", "doc_tokens"), "pieces")


def packed(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` (any columns, ``piece`` and ``length`` among them) plus sequence_id and offset. An empty table stays empty."""
    slot = F.pmod(F.xxhash64("piece"), F.lit(SLOTS))
    counts = stored(pieces.groupBy("length", slot.alias("slot")).agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # Buckets are whole slots, so that one stored count serves any number of them.
    buckets = max(8, min(SLOTS, -(-max(histogram.values(), default=0) // BUCKET_ROWS)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.groupBy("length", (F.col("slot") % buckets).alias("bucket")).agg(F.sum("n").alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("piece")
    ranked = pieces.withColumn("bucket", slot % buckets).withColumn("rank", F.row_number().over(within) - 1).join(offsets, ["length", "bucket"])
    placed = _place(plan(histogram, sequence))("length", F.col("rank") + F.col("before"))
    return ranked.select(*pieces.columns, placed.alias("place")).select(*pieces.columns, "place.*")


def sequences(placed: DataFrame, pad: int, sequence: int = SEQUENCE) -> DataFrame:
    """Per sequence: sequence_id and ids, padded to ``sequence`` unless the count is a power of two. A row gathers at most
    ``sequence`` ids."""
    joined = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])
    rows = placed.groupBy("sequence_id").agg(joined.alias("parts"), F.sum("length").alias("n"))
    whole = F.aggregate("parts", F.lit(b""), lambda a, b: F.concat(a, b))
    power = F.bit_count("n") == 1
    one = np.array([pad], "<u4").tobytes()
    padding = F.when(power, F.lit(b"")).otherwise(F.substring(F.lit(one * sequence), F.lit(1), (4 * (sequence - F.col("n"))).cast("int")))
    return rows.select("sequence_id", F.concat(whole, padding).alias("ids"), "n")
