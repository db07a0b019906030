"""Phrase collocations by best-first branch and bound over prefixes.

A phrase grows word by word. What is known of a prefix bounds every phrase below it:
with ``f`` the number of occurrences, a phrase that begins with x y occurs at most
f(x y) times and its first cut scores at most ``SCALE * f(x y) / f(x)``, so this is an
admissible bound of all three-word phrases below x y. Prefixes are expanded best bound
first, a whole level of the frontier in one pass over the texts: down to the score that
the leading two-word phrases of a language suggest, and lower while fewer than ``top``
phrases at or above that score survive. Once ``top`` survive, no unexpanded prefix can
reach them, ties included, and the language is settled.

Words that are too rare, and prefixes that aren't expanded, are left out in the scan by
bitmaps of a fixed size. A bitmap may let through more than was meant, never less, and
what it lets through is counted in full, so counts are exact whatever its load.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import LOWER, byte_set, hashes, mixed, pieces, runs, stored, text_bytes

LEAST, TOP, SCALE, DROP_PERCENT = 10, 2000, 1_000_000, 50
#: Bits of a bitmap: 4 MB.
BITS = 1 << 25
#: The first frontier reaches down to the score of this many times ``TOP`` two-word phrases, each next one four times as far.
FIRST_WIDTH = 2
#: Bytes of text that are counted together in a task before Spark adds up.
CHUNK = 1 << 20

_BREAK = byte_set((0x0A, 0x0D))
_BREAK[list(b".,;:!?")] = True
_WORD = ~(_BREAK | byte_set((0x20, 0x20), (0x09, 0x09)))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BUCKET = 8 * 4096


def _place(*parts: np.ndarray) -> np.ndarray:
    """Bit of a bitmap for a language and one or two words, given their hashes."""
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = mixed(out * _ODD + p)
    return out & np.uint64(BITS - 1)


def _hashed(column: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(column)
    return hashes(data, offsets[:-1], offsets[1:])


def _bitmap(rows: DataFrame, columns: list[str]) -> np.ndarray:
    """Bytes of the bitmap of all rows; a row's place is the hash of its columns."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = _place(*[_hashed(c) for c in batch.columns])
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(at).astype(np.int64))], ["at"])

    at = rows.select(*columns).mapInArrow(places, "at long")
    parts = at.groupBy(F.floor(F.col("at") / _BUCKET).alias("b")).agg(F.bitmap_construct_agg(F.col("at") % _BUCKET).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for b, bits in parts.collect():  # at most BITS bits
        out[b * 4096: (b + 1) * 4096] |= np.frombuffer(bits, np.uint8)
    return out


def _holds(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _words(lang: pa.Array, text: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """Chunks of (languages, language of each word, distinct words, number of each word, whether the next word follows in the same piece)."""
    data, offsets = text_bytes(text)
    languages = pc.fill_null(lang, "und").dictionary_encode()
    own = np.asarray(languages.indices)
    for low, high in pieces(offsets, CHUNK):
        part = LOWER[data[offsets[low]: offsets[high]]]
        inside = _WORD[part]
        start, end, row = runs(inside, offsets[low: high + 1] - offsets[low])
        if not len(start):
            continue
        bounds = np.concatenate([[0], np.cumsum(end - start)])
        flat = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(part[inside]))])
        coded = flat.dictionary_encode()
        breaks = np.cumsum(_BREAK[part])
        follows = np.zeros(len(start), bool)
        follows[:-1] = (row[1:] == row[:-1]) & (breaks[start[1:]] == breaks[start[:-1]])
        yield languages.dictionary, own[low + row].astype(np.int64), coded.dictionary.cast(pa.binary()), np.asarray(coded.indices).astype(np.int64), follows


_PHRASES = "lang string, phrase string, f long"


def _rows(languages: pa.Array, lang: np.ndarray, columns: list[pa.Array], f: np.ndarray) -> pa.RecordBatch:
    phrase = columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, b" ")
    return pa.RecordBatch.from_arrays([languages.take(pa.array(lang)).cast(pa.string()), phrase.cast(pa.string()), pa.array(f.astype(np.int64))], ["lang", "phrase", "f"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, and of all words under a null phrase."""
    for batch in batches:
        for languages, lang, words, number, _ in _words(batch.column(0), batch.column(1)):
            code, f = np.unique(lang * len(words) + number, return_counts=True)
            yield _rows(languages, code // len(words), [words.take(pa.array(code % len(words)))], f)
            which, f = np.unique(lang, return_counts=True)
            yield _rows(languages, which, [pa.nulls(len(which), pa.binary())], f)


def _pairs_counter(frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(frequent.value, np.uint8)
        for batch in batches:
            for languages, lang, words, number, follows in _words(batch.column(0), batch.column(1)):
                spoken, word = _hashed(languages), _hashed(words)
                often = _holds(bitmap, _place(spoken[lang], word[number]))
                at = np.flatnonzero(follows[:-1] & often[:-1] & often[1:])
                n = len(words)
                code, f = np.unique((lang[at] * n + number[at]) * n + number[at + 1], return_counts=True)
                both = code // n
                yield _rows(languages, both // n, [words.take(pa.array(both % n)), words.take(pa.array(code % n))], f)

    return run


def _triples_counter(frequent, open_, contended):
    """Counts of three words whose two pairs are frequent, whose first pair is open, or that hold a contended pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [np.frombuffer(b.value, np.uint8) for b in (frequent, open_, contended)]
        for batch in batches:
            for languages, lang, words, number, follows in _words(batch.column(0), batch.column(1)):
                at = np.flatnonzero(follows)
                spoken, word = _hashed(languages), _hashed(words)
                pair = _place(spoken[lang[at]], word[number[at]], word[number[at + 1]])
                flags = np.zeros((3, len(lang) + 1), bool)
                for flag, bitmap in zip(flags, maps):
                    flag[at] = _holds(bitmap, pair)
                often, opens, wanted = flags
                at = np.flatnonzero(often[:-1] & often[1:] & (opens[:-1] | wanted[:-1] | wanted[1:]))
                n = len(words)
                pairs, first = np.unique((lang[at] * n + number[at]) * n + number[at + 1], return_inverse=True)
                code, f = np.unique(first.reshape(-1) * n + number[at + 2], return_counts=True)
                both = pairs[code // n]
                rest = both // n
                yield _rows(languages, rest // n, [words.take(pa.array(x)) for x in (rest % n, both % n, code % n)], f)

    return run


def _summed(counted: DataFrame) -> DataFrame:
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _wide(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def _score(a: Column, left: Column, right: Column) -> Column:
    """Exact: the products pass 64 bits."""
    return F.call_function("div", _wide(a) * _wide(a) * _wide(F.lit(SCALE)), _wide(left) * _wide(right))


def collocations(docs: DataFrame, text: str, lang: str, top: int = TOP, least: int = LEAST, width: int = FIRST_WIDTH) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two or three words.

    A null language is ``und`` (and one with a text of that name), a null or blank text has
    no words, repeated rows count again, ties in score go to larger ``a``, then to the
    smaller phrase in byte order. No words give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    share = lambda rows, columns: spark.sparkContext.broadcast(_bitmap(rows, columns).tobytes())

    words = stored(_summed(narrow.mapInArrow(_count_words, _PHRASES)).filter(f"phrase is null or f >= {least}"), "words")
    totals = words.filter("phrase is null").select("lang", F.col("f").alias("n"))
    ones = words.filter("phrase is not null")
    found = _summed(narrow.mapInArrow(_pairs_counter(share(ones, ["lang", "phrase"])), _PHRASES)).filter(F.col("f") >= least)
    split = found.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ")[0].alias("x"), F.split("phrase", " ")[1].alias("y"))
    left = ones.select("lang", F.col("phrase").alias("x"), F.col("f").alias("l"))
    right = ones.select("lang", F.col("phrase").alias("y"), F.col("f").alias("r"))
    pairs = split.join(left, ["lang", "x"]).join(right, ["lang", "y"]).select(
        "lang", "phrase", "x", "y", "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    pairs = stored(pairs.withColumn("bound", F.call_function("div", _wide(F.lit(SCALE)) * _wide(F.col("a")), _wide(F.col("l")))), "pairs")
    frequent = share(pairs, ["lang", "x", "y"])

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    floor = None
    while True:
        # The score of the last of the leading pairs; a language with fewer pairs is expanded as a whole.
        reach = F.row_number().over(best)
        leading = pairs.select("lang", "score", "a", "phrase", reach.alias("k")).filter(F.col("k") <= top * width)
        floor = stored(leading.groupBy("lang").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("c")).select(
            "lang", F.when(F.col("c") < top * width, F.lit(0)).otherwise(F.col("least")).cast("long").alias("floor")), "floors")
        level = pairs.join(floor, "lang")
        contended = level.filter("score >= floor")
        opened = share(level.filter("bound >= floor"), ["lang", "x", "y"])
        counter = _triples_counter(frequent, opened, share(contended, ["lang", "x", "y"]))
        triples = stored(_summed(narrow.mapInArrow(counter, _PHRASES)).filter(F.col("f") >= least), "triples")
        survivors = stored(_survivors(contended, triples, pairs, floor), "survivors")
        open_still = floor.filter("floor > 0").join(survivors.groupBy("lang").count(), "lang", "left").filter(f"coalesce(count, 0) < {top}")
        if open_still.isEmpty():
            break
        width *= 4
    ranked = survivors.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _survivors(contended: DataFrame, triples: DataFrame, pairs: DataFrame, floor: DataFrame) -> DataFrame:
    """Candidates at or above their language's floor that no longer candidate stands for."""
    parts = F.split("phrase", " ")
    three = triples.select("lang", "phrase", F.col("f").alias("a"), F.concat_ws(" ", parts[0], parts[1]).alias("p"), F.concat_ws(" ", parts[1], parts[2]).alias("q"))
    held = three.select("lang", F.explode(F.array("p", "q")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    two = contended.join(held, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < DROP_PERCENT * F.col("a"), F.lit(True)))
    first = pairs.select("lang", F.col("phrase").alias("p"), F.col("a").alias("ab"), F.col("l").alias("x"))
    second = pairs.select("lang", F.col("phrase").alias("q"), F.col("a").alias("bc"), F.col("r").alias("z"))
    cut = three.join(first, ["lang", "p"]).join(second, ["lang", "q"]).withColumns(
        {"s1": _score(F.col("a"), F.col("x"), F.col("bc")), "s2": _score(F.col("a"), F.col("ab"), F.col("z"))})
    lower = F.col("s2") < F.col("s1")
    cut = cut.select("lang", "phrase", "a", F.when(lower, F.col("ab")).otherwise(F.col("x")).alias("l"),
                     F.when(lower, F.col("z")).otherwise(F.col("bc")).alias("r"), F.least("s1", "s2").alias("score"))
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    return two.select(*columns).unionByName(cut.join(floor, "lang").filter("score >= floor").select(*columns))
