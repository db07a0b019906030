"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes with frozen
counts. The probability of a byte in a context of order k mixes by escape: a
seen byte has n / (N + D), and the escape probability D / (N + D) is spread
over the unseen bytes as the next shorter context would spread it (N
occurrences, D distinct bytes). Below order 0 all 256 bytes are equal. So every
context has a proper distribution, and the sum of -log2 p over a text is the
exact length of its code. The language with the shortest code wins.

The trees are counted in tasks and stay sparse: a language costs as much as its
own training texts hold, and changes nothing for the others. As statistics are
frozen, a byte that was seen after its context has a cost of its own, and any
other one costs the context's escape and what the shorter context charges. For
scoring, the trees of up to ``AT_ONCE`` languages are laid side by side, so that
one search finds a context for all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableloom.llm.common import pieces, text_bytes

UNDETERMINED = "und"
#: Bounds of the training sample: texts per language, bytes of a training text, bytes of all languages.
TEXTS, TEXT_BYTES, SAMPLE_BYTES = 400, 1 << 16, 1 << 26
#: Languages whose trees are searched at once.
AT_ONCE = 16
#: A context of three bytes is a node of its language's tree when the training texts hold it so many times.
NODE_COUNT = 4

Grams = list[tuple[np.ndarray, np.ndarray]]


def held_out(key: Column) -> Column:
    """True for a third of the keys, never trained on; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _training_texts(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """Rows (lang, text): about ``TEXTS`` texts of every language, chosen by hash, and an equal share of ``SAMPLE_BYTES`` for each.

    Longer texts than ``TEXT_BYTES`` train only a language without shorter ones, by their beginnings.
    """
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).alias("key")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("key")))
    short = F.octet_length("text") <= TEXT_BYTES
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(short).alias("n_short"))
    room = max(4, SAMPLE_BYTES // max(1, counts.count()))
    # One row per language.
    usable = rows.join(F.broadcast(counts), "lang").filter(short | (F.col("n_short") == 0))
    rate = F.least(F.lit(1.0), F.lit(float(TEXTS)) / F.when(F.col("n_short") > 0, F.col("n_short")).otherwise(F.col("n")))
    place = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 30))
    limit = min(TEXT_BYTES, room)
    # A character has four bytes at most.
    part = F.when(F.octet_length("text") <= limit, F.col("text")).otherwise(F.substring("text", 1, limit // 4))
    chosen = usable.filter(place < rate * (1 << 30)).select("lang", part.alias("text"), place.alias("place"))
    order = Window.partitionBy("lang").orderBy("place", "text")
    return chosen.withColumn("row", F.row_number().over(order)).filter(F.col("row") <= 2 * TEXTS).withColumn(
        "bytes", F.sum(F.octet_length("text")).over(order.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("bytes") <= room).select("lang", "text")


def _grams(data: np.ndarray, offsets: np.ndarray) -> Grams:
    """Distinct runs of one to four bytes within rows, as numbers whose lowest byte is the last one, and their counts."""
    out, run, at = [], data.astype(np.int64), np.arange(len(data))
    start = np.repeat(offsets[:-1], np.diff(offsets))
    for k in range(4):
        if k:
            run = (run[:-1] << 8 | data[k:]) if len(run) > 1 else run[:0]
        inside = at[k:][start[k:] <= at[k:] - k] - k
        out.append(np.unique(run[inside], return_counts=True))
    return out


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        for i, lang in enumerate(coded.dictionary.to_pylist()):
            own = batch.column(1).filter(pa.array(np.asarray(coded.indices) == i))
            for order, (grams, n) in enumerate(_grams(*text_bytes(own))):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(np.full(len(grams), order, np.int32)), pa.array(grams), pa.array(n)],
                                                 ["lang", "k", "gram", "n"])


def _packed_tree(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per order: the language's sorted grams and their counts."""
    out = []
    for k, own in rows.groupby("k"):
        own = own.sort_values("gram")
        out.append((own["lang"].iloc[0], k, own["gram"].to_numpy("<i8").tobytes(), own["n"].to_numpy("<i8").tobytes()))
    return pd.DataFrame(out, columns=["lang", "k", "grams", "counts"])


def learned(docs: DataFrame, key: str, text: str, lang: str) -> Models:
    """Context trees of every language of the training rows, counted in tasks from a bounded sample.

    What comes back is bounded by the sample: at most a gram of each order per byte, and in
    practice a few hundred kilobytes a language. No training rows give no models.
    """
    counts = _training_texts(docs, key, text, lang).mapInArrow(_count_grams, "lang string, k int, gram long, n long")
    summed = counts.groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))
    trees = summed.groupBy("lang").applyInPandas(_packed_tree, "lang string, k int, grams binary, counts binary")
    out: dict[str, Grams] = {}
    for r in trees.collect():
        own = out.setdefault(r["lang"], [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * 4)
        own[r["k"]] = np.frombuffer(r["grams"], "<i8"), np.frombuffer(r["counts"], "<i8")
    return Models({k: out[k] for k in sorted(out)})


def train(sample: dict[str, list[bytes]]) -> Models:
    """Context trees of given texts per language."""
    trees = {}
    for k in sorted(sample):
        sizes = np.concatenate([[0], np.cumsum([len(t) for t in sample[k]])]).astype(np.int64)
        trees[k] = _grams(np.frombuffer(b"".join(sample[k]), np.uint8), sizes)
    return Models(trees)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of numbers among sorted keys, and which of them are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Tree:
    """Costs in bits of one language: of bytes seen after a context, and of leaving the context."""

    def __init__(self, grams: Grams) -> None:
        self.seen: list[tuple[np.ndarray, np.ndarray]] = []
        self.escape: list[tuple[np.ndarray, np.ndarray]] = []
        for k, (keys, n) in enumerate(grams):
            contexts, first, where = np.unique(keys >> 8, return_index=True, return_inverse=True)
            total = np.bincount(where, n, len(contexts))
            if k == 3:
                keep = total[where] >= NODE_COUNT
                keys, n = keys[keep], n[keep]
                contexts, where = np.unique(keys >> 8, return_inverse=True)
                total = np.bincount(where, n, len(contexts))
            distinct = np.bincount(where, minlength=len(contexts))
            # What the shorter context leaves to the bytes not seen here; one that has seen every byte needs no escape.
            left = 1 - np.bincount(where, np.exp2(-self.cost(k - 1, keys & (1 << 8 * k) - 1)), len(contexts))
            every = distinct == 256
            room = np.where(every, total, total + distinct)
            self.seen.append((keys, -np.log2(n / room[where])))
            self.escape.append((contexts, np.where(every, 0.0, np.log2(np.maximum(left, 1e-12)) - np.log2(np.maximum(distinct, 1) / np.maximum(room, 1)))))

    def cost(self, k: int, grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each gram after its ``k`` bytes before."""
        if k < 0:
            return np.full(len(grams), 8.0)
        keys, bits = self.seen[k]
        at, there = _find(keys, grams)
        out = np.zeros(len(grams))
        out[there] = bits[at[there]]
        rest = np.flatnonzero(~there)
        if len(rest):
            out[rest] = self.leave(k, grams[rest] >> 8) + self.cost(k - 1, grams[rest] & (1 << 8 * k) - 1)
        return out

    def leave(self, k: int, contexts: np.ndarray) -> np.ndarray:
        """Bits of the escape from each context; a context that was never seen is left for nothing."""
        keys, bits = self.escape[k]
        at, there = _find(keys, contexts)
        out = np.zeros(len(contexts))
        out[there] = bits[at[there]]
        return out


class Index:
    """Row of each of some 32-bit numbers, -1 for others: a hashed table, searched for many numbers at once."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = max(8, int(4 * len(keys)).bit_length())
        self.keys, self.rows = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.rows[at] < 0
            self.rows[at[free]] = todo[free]  # of several numbers the last one stays
            self.keys[at[free]] = keys[todo[free]]
            left = self.rows[at] != todo
            todo, at = todo[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(32 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out, held = self.rows[at], self.keys[at]
        wrong = np.flatnonzero((held != keys) & (out >= 0))
        out[wrong] = -2
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            slot = at[wrong]
            same, free = self.keys[slot] == keys[wrong], self.rows[slot] < 0
            out[wrong[same]] = self.rows[slot[same]]
            out[wrong[free]] = -1
            wrong = wrong[~same & ~free]
        return out


class Block:
    """Trees of several languages side by side: rows of bits for grams that any of them has seen."""

    def __init__(self, trees: list[Tree]) -> None:
        side_by_side = lambda columns: np.stack(columns, 1).astype(np.float32)
        self.first = side_by_side([t.cost(0, np.arange(256)) for t in trees])
        self.second = side_by_side([t.cost(1, np.arange(1 << 16)) for t in trees])
        self.grams, self.leave = {}, {}
        for k in (2, 3):
            keys = np.unique(np.concatenate([t.seen[k][0] for t in trees]))
            self.grams[k] = Index(keys), side_by_side([t.cost(k, keys) for t in trees])
            keys = np.unique(np.concatenate([t.escape[k][0] for t in trees]))
            self.leave[k] = Index(keys), side_by_side([t.leave(k, keys) for t in trees])

    def cost(self, k: int, grams: np.ndarray) -> np.ndarray:
        """Bits [gram][language] of the last byte of each gram after its ``k`` bytes before."""
        if k < 2:
            return (self.first, self.second)[k][grams]
        index, bits = self.grams[k]
        row = index.find(grams)
        out = bits[row] if len(bits) else np.zeros((len(grams), self.first.shape[1]), np.float32)
        rest = np.flatnonzero(row < 0)
        if len(rest):
            short = self.cost(k - 1, grams[rest] & (1 << 8 * k) - 1)
            index, bits = self.leave[k]
            node = index.find(grams[rest] >> 8)
            held = np.flatnonzero(node >= 0)
            short[held] += bits[node[held]]
            out[rest] = short
        return out


@dataclass
class Models:
    trees: dict[str, Grams]  # per language, sorted by name

    @property
    def languages(self) -> list[str]:
        return list(self.trees)

    @cached_property
    def blocks(self) -> list[Block]:
        """Built where texts are scored; only the counts travel."""
        trees = [Tree(g) for g in self.trees.values()]
        return [Block(trees[i: i + AT_ONCE]) for i in range(0, len(trees), AT_ONCE)]


def code_lengths(models: Models, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each row's text under each language: [row][language]. The first three bytes have shorter contexts."""
    out = np.zeros((len(offsets) - 1, len(models.languages)))
    for low, high in pieces(offsets):
        at = offsets[low: high + 1]
        own = data[at[0]: at[-1]].astype(np.int64)
        if len(own) == 0:
            continue
        at = at - at[0]
        rows = np.flatnonzero(at[1:] > at[:-1])
        run = own.copy()
        for i in (1, 2, 3):
            run[i:] |= own[:-i] << 8 * i
        begins = []
        for k in range(3):
            place = at[:-1][rows] + k
            begins.append(place[place < at[1:][rows]])
        for i, block in enumerate(models.blocks):
            cost = block.cost(3, run)
            for k, place in enumerate(begins):
                cost[place] = block.cost(k, run[place] & (1 << 8 * (k + 1)) - 1)
            out[low + rows, i * AT_ONCE: i * AT_ONCE + cost.shape[1]] = np.add.reduceat(cost, at[:-1][rows], axis=0, dtype=np.float64)
    return out


def predictor(models: Models, spark: SparkSession):
    """Column function from a text to its language, the language's posterior and the bits of its code."""
    shared = spark.sparkContext.broadcast(models)

    def predict(text: pa.Array) -> pa.Array:
        models = shared.value
        data, offsets = text_bytes(text)
        bits = code_lengths(models, data, offsets)
        best = bits.argmin(1)
        # Equal priors: the posterior is the winner's share of 2 ** -bits.
        odds = np.exp2(-np.minimum(bits - bits.min(1, keepdims=True), 1000.0))
        names = np.array(models.languages, object)[best]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(1 / odds.sum(1), pa.float64()),
             pa.array(bits.min(1), pa.float64())],
            ["lang", "score", "bits"])

    return F.arrow_udf(predict, "lang string, score double, bits double")


def with_language(docs: DataFrame, models: Models, text: str, result: str) -> DataFrame:
    """Add struct ``result`` of lang, score (0 to 1) and bits (code length under the winner).

    A null text or one without a letter has lang ``und``, score 0 and 0 bits,
    and so has every text if nothing was learned. Ties go to the name that
    sorts first. Other columns stay as they are; equal rows get equal results.
    """
    none = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits"))
    if not models.languages:
        return docs.withColumn(result, none)
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    found = predictor(models, docs.sparkSession)(F.coalesce(F.col(text), F.lit("")))
    return docs.withColumn(result, found).withColumn(result, F.when(letters, F.col(result)).otherwise(none))


#: A text is in no learned language if its best model's code is so many bits longer than the raw bytes.
EXCESS_BITS = 64


def accepted(result: str, text: str) -> Column:
    """False for texts without a determined language, or whose best model is clearly worse than no model."""
    return (F.col(f"{result}.lang") != UNDETERMINED) & (F.col(f"{result}.bits") < 8 * F.octet_length(text) + EXCESS_BITS)
