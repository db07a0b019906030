"""Spelling variants: words one edit apart, and the frequent form each rare one stands for.

Two words are near if one inserted, deleted or replaced code point turns one into
the other. One edit leaves either the first ``m // 2`` code points or the last
``m - m // 2`` of the shorter word (``m`` code points) in place, so near words share
one of these halves; words are grouped by half, and a group too large for one block
is cut in parts that meet in pairs. Every pair has just one group: pairs whose first
halves agree are left to that group.

Inside a block the words are a bit-sliced position index: for a position and a letter
one bit per word. All words of the block are queries at once; four bit sets per query
are carried over its letters, each one step of whole machine words: no error so far,
one letter replaced, the word one letter ahead, the word one letter behind. Bits are
in order of descending count, so the first set bit is the form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import stored

LEAST_LETTERS, LEAST_COUNT, FORM_FACTOR = 7, 2, 10
#: Words of one block of the index.
BLOCK = 2048

RUN = "[A-Za-z\\u00C0-\\u00FF]"
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(docs: DataFrame, key: str, text: str, planted: bool = True) -> DataFrame:
    """One row (word) per run of letters that may count; ``planted`` deletes a letter by checksum from one run in 31."""
    runs = docs.select(F.col(key).cast("string").alias("k"), F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{LEAST_LETTERS},}}"), F.lit(0))).alias("r"))
    lower = F.when(F.col("r").rlike("[A-Z]"), F.translate("r", _UPPER, _SMALL)).otherwise(F.col("r"))
    words = runs.select("k", lower.alias("word"))
    if planted:
        h = words.select("word", F.crc32(F.concat("k", F.lit(":"), "word").cast("binary")).alias("h"))
        at = (F.col("h") % F.char_length("word")).cast("int")
        without = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
        words = h.select(F.when(F.col("h") % 31 == 0, without).otherwise(F.col("word")).alias("word"))
    return words.filter(F.char_length("word") >= LEAST_LETTERS).select("word")


def vocabulary(words: DataFrame) -> DataFrame:
    """Rows (word, n) of words that occur often enough."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _members(words: DataFrame, block: int) -> DataFrame:
    """Rows (m, side, half, i, j, part, word, n): every word in the cells where it may meet near words."""
    size = F.char_length("word")

    def halves(m: Column) -> list[Column]:
        h = F.floor(m / 2).cast("int")
        first, last = F.substring("word", F.lit(1), h), F.right("word", m - h)
        return [F.struct(m.alias("m"), F.lit(side).alias("side"), half.alias("half")) for side, half in ((0, first), (1, last))]

    shorter, longer = halves(size), halves(size - 1)
    grouped = words.withColumn("g", F.explode(F.when(size > LEAST_LETTERS, F.array(*shorter, *longer)).otherwise(F.array(*shorter)))).select("g.*", "word", "n")
    key = ["m", "side", "half"]
    sizes = grouped.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    parts = F.ceil(F.col("size") / F.lit(block)).cast("int")
    placed = grouped.join(sizes, key).withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return met.select(*key, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "word", "n")


_FOUND = "word string, n long, n_near long, near_n long, near string"


def _packed(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words, the first flag in the lowest bit."""
    n = flags.shape[1]
    full = np.zeros((len(flags), -(-n // 64) * 64), bool)
    full[:, :n] = flags
    return np.packbits(full, axis=1, bitorder="little").view("<u8")


def near_in_block(words: list[str], n: np.ndarray, group: np.ndarray, m: np.ndarray, side: np.ndarray, part: np.ndarray, crossed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of near words of each word within its group, and the place of the one of largest count (-1: none).

    ``m`` and ``side`` are the group's; words of a ``crossed`` group meet only words of another part.
    """
    order = np.array(sorted(range(len(words)), key=lambda x: (-n[x], words[x])), np.int64)
    words = [words[x] for x in order]
    group, m, side, part, crossed = (x[order] for x in (group, m, side, part, crossed))
    size = np.array([len(w) for w in words], np.int64)
    most, total = int(size.max()), len(words)
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    letters, code = np.unique(points, return_inverse=True)
    start = np.concatenate([[0], np.cumsum(size)])
    half = m // 2

    def table(at: int) -> np.ndarray:
        """One bit per word for each letter at a position; the last row is for no letter."""
        flags = np.zeros((len(letters) + 1, total), bool)
        if 0 <= at < most:
            has = np.flatnonzero(size > at)
            flags[code[start[has] + at], has] = True
        return _packed(flags)

    _, gid = np.unique(group, return_inverse=True)
    same = np.zeros((gid.max() + 1, total), bool)
    same[gid, np.arange(total)] = True
    none = _packed(same)[gid]
    if crossed.any():
        _, own = np.unique(np.stack([gid, part]), axis=1, return_inverse=True)
        own = own.reshape(-1)
        kin = np.zeros((own.max() + 1, total), bool)
        kin[own, np.arange(total)] = True
        none[crossed] &= ~_packed(kin)[own][crossed]
    replaced, ahead, behind = np.zeros_like(none), np.zeros_like(none), np.zeros_like(none)
    here, before = table(0), table(-1)
    for at in range(most):
        after = table(at + 1)
        active = np.flatnonzero(size > at)
        c = code[start[active] + at]
        z, b0 = none[active], here[c]
        ahead[active] = (ahead[active] | z) & after[c]
        replaced[active] = (replaced[active] & b0) | (z & ~b0)
        behind[active] = (behind[active] & before[c]) | z
        none[active] = z & b0
        cut = np.flatnonzero((side == 1) & (half == at + 1))
        for x in (replaced, ahead, behind):
            x[cut] &= ~none[cut]
        none[cut] = 0
        before, here = here, after
    lengths, which = np.unique(size, return_inverse=True)
    of_length = _packed(np.concatenate([size == v for v in lengths]).reshape(len(lengths), total))
    place = {int(v): x for x, v in enumerate(lengths)}
    blank = np.zeros_like(of_length[0])
    masks = [np.stack([of_length[place[int(v) + d]] if int(v) + d in place else blank for v in lengths])[which] for d in (-1, 0, 1)]
    short = (size == m)[:, None]
    found = np.where(short, (replaced & masks[1]) | ((ahead | none) & masks[2]), behind & masks[0])
    counts = np.bitwise_count(found).sum(1).astype(np.int64)
    first = np.argmax(found != 0, axis=1)
    low = found[np.arange(total), first]
    bit = np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)).astype(np.int64)
    best = np.where(counts > 0, order[np.minimum(first * 64 + bit, total - 1)], -1)
    out_counts, out_best = np.zeros(total, np.int64), np.full(total, -1, np.int64)
    out_counts[order], out_best[order] = counts, best
    return out_counts, out_best


def _near(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def searched(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            """Whole groups, a block's worth of words at a time."""
            if not rows:
                return
            cols = list(zip(*rows))
            m, side, i, j, part, n, group = (np.array(cols[x], np.int64) for x in (0, 1, 3, 4, 5, 7, 8))
            words = list(cols[6])
            counts, best = near_in_block(words, n, group, m, side, part, i != j)
            hit = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array([words[x] for x in hit], pa.string()), pa.array(n[hit]), pa.array(counts[hit]),
                pa.array(n[best[hit]]), pa.array([words[x] for x in best[hit]], pa.string()),
            ], ["word", "n", "n_near", "near_n", "near"])

        rows, group, last, number = [], [], None, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:5] != last:
                    if len(group) > 1:
                        rows += group
                    if rows and (len(rows) >= block or rows[-1][0] != row[0]):  # words of very different length make no common block
                        yield from searched(rows)
                        rows = []
                    group, last, number = [], row[:5], number + 1
                group.append((*row, number))
        yield from searched(rows + group if len(group) > 1 else rows)

    return run


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (word, n_near, near_n, near) of words that have near words, with the one of largest count."""
    key = ["m", "side", "half", "i", "j"]
    cells = _members(words, block).repartition(*key).sortWithinPartitions(*key)
    found = cells.mapInArrow(_near(block), _FOUND)
    best = F.min(F.struct((-F.col("near_n")).alias("x"), F.col("near").alias("near")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.x")).alias("near_n"), F.col("b.near").alias("near"))


def _roots(links: DataFrame) -> DataFrame:
    """Rows (word, root) of links (word, form). Counts grow tenfold with each link, so there are no circles; each round doubles the steps taken."""
    now = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = stored(step, "roots")
        now = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return now


def grouped(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) of the distinct words (word, n).

    ``form`` is the near word of largest count, the first in code-point order among equals,
    if that count is ten times the word's or more; ``root`` the end of the forms' chain.
    No words give no rows; a word without near words has n_near 0 and itself as root.
    """
    words = stored(words, "words")
    near = near_words(words, block).withColumnRenamed("word", "w")
    linked = words.join(near, F.col("word") == F.col("w"), "left").drop("w")
    frequent = F.col("near_n") >= FORM_FACTOR * F.col("n")
    linked = stored(linked.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                  F.when(frequent, F.col("near")).alias("form"), F.when(frequent, F.col("near_n")).alias("form_n")), "forms")
    roots = _roots(linked.filter("form is not null"))
    return linked.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, key: str, text: str, planted: bool = True, block: int = BLOCK) -> DataFrame:
    """Spelling variants of all words of whole texts; see ``grouped``.

    A null or blank text has no words, a row with a null key has nothing deleted, repeated
    rows count again, other columns are not read. A very long run of letters is a word like any other.
    """
    return grouped(vocabulary(occurrences(docs, key, text, planted)), block)
