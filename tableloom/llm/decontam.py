"""Benchmark decontamination by suffix arrays over the training texts.

A shard is one batch of documents as Spark reads them. Its suffix array holds
the places from which a run of benchmark words is long enough for a window,
since no other suffix can match one; it is sorted by as many words as the longest
window has. Every distinct window of the benchmark, the beginning of a test
suffix, is looked up by binary search for its first and last suffix, for all
windows at once. The suffixes between give all verbatim places; overlapping ones
make up the longest matches.

The benchmark is taken in blocks of about ``BLOCK`` bytes, each sent to the tasks
and searched in all documents, and the blocks' findings are joined per document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import ALNUM, LOWER, hashes, mixed, pieces, runs, stored, text_bytes, unused

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
BLOCK = 8 << 20


@dataclass
class Windows:
    """The distinct windows of a block: ``words`` [window][place], 0 past the end, and the items that hold each."""

    vocabulary: np.ndarray  # sorted hashes; a word's number is its place + 1
    words: np.ndarray
    sizes: np.ndarray
    edges: np.ndarray
    items: np.ndarray


def windows(rows: list[tuple[int | None, str | None]]) -> Windows:
    """Windows of benchmark rows (item id, text). Items without words have none; a null id is not listed."""
    data, offsets = text_bytes(pa.array([t for _, t in rows], pa.string()))
    low = LOWER[data] if len(data) else data
    start, end, row = runs(ALNUM[low], offsets)
    words = hashes(low, start, end) if len(start) else np.zeros(0, np.uint64)
    vocabulary, number = np.unique(words, return_inverse=True)
    counts = np.bincount(row, minlength=len(rows))
    first = np.concatenate([[0], np.cumsum(counts)])
    at, size = [], []
    for i, n in enumerate(counts):
        if n:
            places = first[i] + np.arange(max(n - WINDOW + 1, 1))
            at.append(places)
            size.append(np.full(len(places), min(n, WINDOW)))
    if not at:
        return Windows(vocabulary, np.zeros((0, WINDOW), np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64))
    at, size = np.concatenate(at), np.concatenate(size)
    steps = np.arange(WINDOW)
    inside = steps < size[:, None]
    grid = np.where(inside, number[np.minimum(at[:, None] + steps, len(number) - 1)] + 1, 0)
    distinct, of = np.unique(grid, axis=0, return_inverse=True)
    of = of.ravel()
    item = row[at]
    pair = np.unique(of * len(rows) + item)
    pair = pair[np.array([rows[i][0] is not None for i in pair % len(rows)], bool)]
    ids = np.array([rows[i][0] for i in pair % len(rows)], np.int64)
    return Windows(vocabulary, distinct, (distinct > 0).sum(1), np.searchsorted(pair // len(rows), np.arange(len(distinct) + 1)), ids)


def _suffix_array(numbers: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The places in order of the WINDOW words from each on, by doubling the words that ranks stand for."""
    rank = numbers.astype(np.int64)
    done = 1
    while done < WINDOW:
        later = np.zeros(len(rank), np.int64)
        later[:-done] = rank[done:]
        _, rank = np.unique(rank * (later.max(initial=0) + 1) + later, return_inverse=True)
        rank = rank.ravel().astype(np.int64)
        done *= 2
    return places[np.argsort(rank[places], kind="stable")]


def _bound(numbers: np.ndarray, array: np.ndarray, found: Windows, after: bool) -> np.ndarray:
    """For each window, how many suffixes come before it, or (``after``) before or begin with it."""
    low, high = np.zeros(len(found.words), np.int64), np.full(len(found.words), len(array))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        at = array[middle]
        less, same = np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for i in range(WINDOW):
            inside = same & (i < found.sizes[open_])
            here, there = numbers[np.minimum(at + i, len(numbers) - 1)], found.words[open_, i]
            less |= inside & (here < there)
            same &= ~inside | (here == there)
        up = less | (same & after)
        low[open_[up]] = middle[up] + 1
        high[open_[~up]] = middle[~up]
    return low


def _search(found: Windows):
    """Column function from a text to n_words, spans (word ranges of the longest matches) and items."""
    least = int(found.sizes.min(initial=WINDOW))

    def search(text: pa.Array) -> pa.Array:
        data, offsets = text_bytes(text)
        n = len(offsets) - 1
        counts, kept_numbers, kept_row, kept_word = np.zeros(n, np.int64), [], [], []
        for low, high in pieces(offsets):
            at = offsets[low: high + 1]
            lower = LOWER[data[at[0]: at[-1]]]
            start, end, row = runs(ALNUM[lower], at - at[0])
            if not len(start):
                continue
            counts[low:high] = np.bincount(row, minlength=high - low)
            if not len(found.words):
                continue
            words = hashes(lower, start, end)
            place = np.minimum(np.searchsorted(found.vocabulary, words), len(found.vocabulary) - 1)
            number = np.where(found.vocabulary[place] == words, place + 1, 0)
            first = np.searchsorted(row, np.arange(high - low))
            # Runs of benchmark words, each followed by one 0.
            s, e, _ = runs(number > 0, np.append(first, len(row)))
            long = e - s >= least
            s, e = s[long], e[long]
            if not len(s):
                continue
            sizes = e - s + 1
            index = np.repeat(s - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            tail = np.cumsum(sizes) - 1
            value = number[np.minimum(index, len(number) - 1)]
            value[tail] = 0
            kept_numbers.append(value)
            of = row[np.minimum(index, len(row) - 1)]
            of[tail] = of[tail - 1]
            kept_row.append(of + low)
            kept_word.append(index - first[of])
        spans: list[list] = [[] for _ in range(n)]
        items: list[list] = [[] for _ in range(n)]
        if kept_numbers:
            numbers, row, word = np.concatenate(kept_numbers), np.concatenate(kept_row), np.concatenate(kept_word)
            array = _suffix_array(numbers, np.flatnonzero(numbers))
            low, high = _bound(numbers, array, found, False), _bound(numbers, array, found, True)
            hit = np.flatnonzero(high > low)
            many = high[hit] - low[hit]
            window = np.repeat(hit, many)
            at = array[np.repeat(low[hit] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())]
            if len(at):
                cover = np.zeros(len(numbers) + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + found.sizes[window], -1)
                covered = np.cumsum(cover[:-1]) > 0
                edge = np.searchsorted(row, np.arange(n + 1))
                for s, e, r in zip(*(x.tolist() for x in runs(covered, edge))):
                    spans[r].append({"start": int(word[s]), "end": int(word[e - 1]) + 1})
                pair = np.unique(row[at] * len(found.words) + window)
                for r, w in zip((pair // len(found.words)).tolist(), (pair % len(found.words)).tolist()):
                    items[r].append(found.items[found.edges[w]: found.edges[w + 1]])
        listed = [np.unique(np.concatenate(x)).tolist() if x else [] for x in items]
        return pa.StructArray.from_arrays(
            [pa.array(counts), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(listed, pa.list_(pa.int64()))],
            ["n_words", "spans", "items"])

    return F.arrow_udf(search, "n_words long, spans array<struct<start: long, end: long>>, items array<long>")


def _covered() -> Column:
    """Words in the union of ``spans``, which are sorted by start."""
    step = lambda acc, x: F.struct(
        (acc["n"] + F.greatest(x["end"] - F.greatest(x["start"], acc["end"]), F.lit(0))).alias("n"), F.greatest(acc["end"], x["end"]).alias("end"))
    return F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")), step, lambda acc: acc["n"])


def matches(docs: DataFrame, key: str, text: str, bench: DataFrame, item: str, item_text: str) -> DataFrame:
    """Per row of ``docs``: row_key, key, n_words, n_hit (words inside a window's place), spans and items (ids, sorted).

    Null or wordless texts have no words and no hits; an empty benchmark hits
    nothing. Repeated rows give as many equal rows; repeated items count once.
    A null item id hits but is not listed.
    """
    size = bench.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK))
    found = None
    for block in range(blocks):
        part = bench.select(F.col(item).cast("long").alias("i"), F.col(item_text).alias("t")).filter(
            F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        search = _search(windows([(r["i"], r["t"]) for r in part.collect()]))
        rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("print"), search(F.coalesce(F.col(text), F.lit(""))).alias("m"))
        rows = stored(rows.select("key", "print", "m.*"), "matches")
        found = rows if found is None else found.unionByName(rows)
    merged = found.groupBy("key", "print").agg(
        F.max("n_words").alias("n_words"), F.collect_set(F.struct("spans", "items")).alias("m"), (F.count("*") / blocks).cast("int").alias("copies"))
    return merged.select(
        "key", "print", "n_words", F.array_sort(F.flatten("m.spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten("m.items"))).alias("items"),
        F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("col").withColumn("n_hit", _covered())


def clean(docs: DataFrame, key: str, text: str, bench: DataFrame, item: str, item_text: str) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of the benchmark."""
    named, printed = unused(docs, "__key"), unused(docs, "__print")
    hit = matches(docs, key, text, bench, item, item_text).filter("n_hit > 0").select(F.col("key").alias(named), F.col("print").alias(printed)).distinct()
    same = docs[key].eqNullSafe(F.col(named)) & (F.xxhash64(docs[text]) == F.col(printed))
    return docs.join(hit, same, "left_anti")
