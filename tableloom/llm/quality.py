"""Quality rules with robust multivariate outliers.

Each text gives a vector of transformed statistics. Per language and source,
the minimum covariance determinant estimate is found by concentration steps
over all documents: from several deterministic starts, then again and again from
the three quarters of the group that lie nearest, until the determinant stops
falling. The start that ends with the least determinant counts. A document whose
Mahalanobis distance from its group exceeds the cutoff is rejected.

Every step is a grouped sum over one narrow row per document, so a group may
hold any share of the rows: sums combine before the shuffle, and group values
reach the rows by a join on the group and a salt. Quantiles are read off counts
of binned values, which add up exactly whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import SPACED, byte_set, hashes, pieces, runs, shingles, stored, text_bytes

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_MARKS = byte_set((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_UPPER, _CONTINUES = byte_set((0x41, 0x5A)), byte_set((0x80, 0xBF))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_upper")


def _counted(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """COUNTS of each row."""
    n = len(offsets) - 1
    out = np.zeros((n, len(COUNTS)), np.int64)
    start, end, row = runs(SPACED[data], offsets)

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[offsets[1:]] - total[offsets[:-1]]

    out[:, 0] = np.bincount(row, minlength=n)
    out[:, 1] = per_row(SPACED[data] & ~_CONTINUES[data])
    out[:, 2] = per_row(SYMBOLS[data])
    out[:, 6] = per_row(_MARKS[data])
    out[:, 7] = per_row(_UPPER[data])
    # Lines with a word; every later copy of a row's line counts.
    low, high, of = runs(data != 10, offsets)
    if len(start):
        at = np.searchsorted(start, low)
        worded = (at < len(start)) & (start[np.minimum(at, len(start) - 1)] < high)
        low, high, of = low[worded], high[worded], of[worded]
        lines = hashes(data, low, high)
        order = np.lexsort((lines, of))
        again = (of[order][1:] == of[order][:-1]) & (lines[order][1:] == lines[order][:-1])
        out[:, 5] = np.bincount(of, minlength=n)
        out[:, 3] = np.bincount(of[order][1:][again], minlength=n)
    # Words in windows of three that the text holds twice or more.
    three, at = shingles(hashes(data, start, end), row, 3)
    if len(at):
        order = np.lexsort((three, row[at]))
        same = (row[at][order][1:] == row[at][order][:-1]) & (three[order][1:] == three[order][:-1])
        often = at[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
        covered = np.zeros(len(start), bool)
        for i in range(3):
            covered[often + i] = True
        out[:, 4] = np.bincount(row[covered], minlength=n)
    return out


def _count_column(text: pa.Array) -> pa.Array:
    data, offsets = text_bytes(text)
    out = np.zeros((len(text), len(COUNTS)), np.int64)
    for low, high in pieces(offsets):
        at = offsets[low: high + 1]
        out[low:high] = _counted(data[at[0]: at[-1]], at - at[0])
    return pa.StructArray.from_arrays([pa.array(out[:, i]) for i in range(len(COUNTS))], list(COUNTS))


def text_counts(text: Column) -> Column:
    """Struct of COUNTS of a text."""
    return F.arrow_udf(_count_column, ", ".join(f"{c} long" for c in COUNTS))(text)


#: The vector: names, and the least standard deviation that an estimate may have in each.
VECTOR = ("words", "length", "symbols", "marks", "upper", "lines", "repeats")
LEAST = (0.25, 0.06, 0.02, 0.03, 0.03, 0.08, 0.08)
_P = len(VECTOR)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
#: Share of a group that the estimate rests on, least fall of the determinant's logarithm, least rows of a group of its own.
KEPT_SHARE, FALL, GROUP_ROWS = 0.75, 1e-3, 60
SALTS = 32
BIN = 1 / 256


def vector() -> list[Column]:
    """Logarithms of the number and length of words; square roots of shares, which even out their spread."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    share = lambda a, b: F.sqrt(F.least(F.col(a) / b, F.lit(1.0)))
    columns = (F.log(words), F.log(chars / words), share("n_symbols", chars), share("n_marks", chars),
               share("n_upper", chars), share("n_dup_lines", lines), share("n_repeat_words", words))
    return [c.alias(name) for c, name in zip(columns, VECTOR)]


def chi_square(quantile_z: float) -> float:
    """Quantile of the chi-square law of the vector's dimension, from the normal quantile (Wilson and Hilferty)."""
    return _P * (1 - 2 / (9 * _P) + quantile_z * (2 / (9 * _P)) ** 0.5) ** 3


def _chi_square_share(x: float, freedom: int) -> float:
    """Share of the chi-square law below ``x``, by the series of the incomplete gamma function."""
    a, term, total = freedom / 2, 1.0, 1.0
    for n in range(1, 400):
        term *= x / 2 / (a + n)
        total += term
    return exp(a * log(x / 2) - x / 2 - lgamma(a + 1)) * total


def _consistency(share: float) -> float:
    """By how much the covariance of the nearest ``share`` of normal rows is below that of all."""
    low, high = 0.0, 100.0
    for _ in range(60):
        x = (low + high) / 2
        low, high = (x, high) if _chi_square_share(x, _P) < share else (low, x)
    return share / _chi_square_share(high, _P + 2)


CONSISTENCY = _consistency(KEPT_SHARE)
#: The quantile of the chi-square law at seven standard deviations.
CUTOFF = chi_square(7.0)


def _quantile(counts: DataFrame, keys: list[str], share: float, value: Column) -> DataFrame:
    """Upper edge of the bin in which each key's share of its rows is reached."""
    ordered = Window.partitionBy(*keys).orderBy("bin")
    total = F.sum("n").over(Window.partitionBy(*keys))
    run = F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return counts.withColumn("run", run).withColumn("all", total).filter(F.col("run") >= share * F.col("all")).groupBy(*keys).agg(
        F.min("bin").alias("bin"), F.max("all").alias("rows")).select(*keys, value.alias("q"), "rows")


def _salted(groups: DataFrame) -> DataFrame:
    return groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _distance() -> Column:
    """Squared Mahalanobis distance from the joined centre ``m`` and inverse ``w`` (upper triangle)."""
    total = F.lit(0.0)
    for k, (i, j) in enumerate(_PAIRS):
        term = (F.col(VECTOR[i]) - F.col("m")[i]) * (F.col(VECTOR[j]) - F.col("m")[j]) * F.col("w")[k]
        total = total + (term if i == j else 2 * term)
    return F.greatest(total, F.lit(0.0))


def _estimate(mean: np.ndarray, cov: np.ndarray) -> tuple[list[float], list[float], float]:
    """Centre, inverse covariance and logarithm of the determinant. A deviation below LEAST is raised to it."""
    cov = cov + np.diag(np.maximum(np.square(LEAST) - np.diag(cov), 0) + 1e-9)
    inverse = np.linalg.inv(cov)
    return mean.tolist(), [float(inverse[i, j]) for i, j in _PAIRS], float(np.linalg.slogdet(cov)[1])


def _matrix(values: np.ndarray) -> np.ndarray:
    out = np.zeros((_P, _P))
    for (i, j), v in zip(_PAIRS, values):
        out[i, j] = out[j, i] = v
    return out


def _concentrated(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Estimates from the sums of each group and start."""
    for f in frames:
        rows = []
        for g, start, n, sums, squares in zip(f["g"], f["start"], f["n"], f["s"], f["ss"]):
            mean = np.asarray(sums) / n
            rows.append((g, start, *_estimate(mean, _matrix(np.asarray(squares) / n) - np.outer(mean, mean))))
        yield pd.DataFrame(rows, columns=["g", "start", "m", "w", "det"])


def _starts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Starts of each group around its medians: median deviations, covariance of hyperbolic tangents, covariance of spatial signs."""
    for f in frames:
        rows = []
        for g, n, m, d, sums, squares, signs in zip(f["g"], f["n"], f["m"], f["d"], f["s"], f["ss"], f["uu"]):
            mean, scale = np.asarray(sums) / n, np.outer(d, d)
            for start, cov in enumerate((np.eye(_P), _matrix(np.asarray(squares) / n) - np.outer(mean, mean), _matrix(np.asarray(signs) / n) * _P)):
                middle, inverse, _ = _estimate(np.asarray(m), cov * scale)
                rows.append((g, start, middle, inverse, float("inf")))
        yield pd.DataFrame(rows, columns=["g", "start", "m", "w", "det"])


_ESTIMATE = "g string, start int, m array<double>, w array<double>, det double"


def _sums(columns: list[Column]) -> Column:
    return F.array(*[F.sum(c) for c in columns])


def _products(columns: list[Column]) -> Column:
    return F.array(*[F.sum(columns[i] * columns[j]) for i, j in _PAIRS])


def least_determinants(grouped: DataFrame, starts: DataFrame) -> DataFrame:
    """(g, m, w): of all starts' estimates in each group the one of the least determinant. ``grouped``: g, salt, VECTOR.

    A start takes concentration steps until its determinant falls by less than
    FALL, so their number is bounded by the first estimate's determinant.
    """
    active, estimates = starts, []
    while not active.isEmpty():
        far = grouped.join(_salted(active.withColumnRenamed("det", "before")), ["g", "salt"]).withColumn("far", F.log2(_distance() + 1e-6))
        bins = far.groupBy("g", "start", F.floor(F.col("far") * 64).alias("bin")).agg(F.count("*").alias("n"))
        within = _quantile(bins, ["g", "start"], KEPT_SHARE, (F.col("bin") + 1) / 64)
        near = far.join(_salted(within), ["g", "start", "salt"]).filter(F.col("far") < F.col("q"))
        columns = [F.col(c) for c in VECTOR]
        sums = near.groupBy("g", "start").agg(F.count("*").alias("n"), _sums(columns).alias("s"), _products(columns).alias("ss"))
        found = stored(sums.mapInPandas(_concentrated, _ESTIMATE), "estimate")
        estimates.append(found)
        before = active.select("g", "start", F.col("det").alias("before"))
        active = found.join(before, ["g", "start"]).filter(F.col("before") - F.col("det") >= FALL).drop("before")
    every = estimates[0] if estimates else starts
    for more in estimates[1:]:
        every = every.unionByName(more)
    return every.groupBy("g").agg(F.min_by(F.struct("m", "w"), F.struct("det", "start")).alias("x")).select("g", "x.m", "x.w")


def robust_distances(rows: DataFrame, lang: str, source: str) -> DataFrame:
    """``rows`` (with COUNTS) plus ``distance``: squared, corrected for consistency with the chi-square law.

    A language and source with fewer than GROUP_ROWS rows joins the other small
    sources of its language, and a language with few such rows joins those of
    other languages. Null names are names like others.
    """
    named = rows.select("*", *vector(), F.coalesce(F.col(lang).cast("string"), F.lit("\0")).alias("l"),
                        F.coalesce(F.col(source).cast("string"), F.lit("\0")).alias("s0"))
    named = named.withColumn("salt", F.pmod(F.xxhash64(*COUNTS, *rows.columns[:1]), F.lit(SALTS)).cast("int"))
    sizes = named.groupBy("l", "s0").agg(F.count("*").alias("n"))
    small = sizes.filter(F.col("n") < GROUP_ROWS).groupBy("l").agg(F.sum("n").alias("rest"))
    groups = sizes.join(small, "l", "left").select("l", "s0", F.when(F.col("n") >= GROUP_ROWS, F.concat_ws("\1", "l", "s0"))
                                                   .when(F.col("rest") >= GROUP_ROWS, F.col("l")).otherwise("").alias("g"))
    grouped = stored(named.join(_salted(groups), ["l", "s0", "salt"]).drop("l", "s0"), "quality")

    def binned(frame: DataFrame, value: Column) -> DataFrame:
        each = F.explode(F.array(*[F.struct(F.lit(i).alias("d"), F.floor(value(F.col(c), i) / BIN).alias("bin")) for i, c in enumerate(VECTOR)])).alias("x")
        return frame.select("g", each).groupBy("g", "x.d", "x.bin").agg(F.count("*").alias("n"))

    edge = (F.col("bin") + 0.5) * BIN
    as_array = lambda name: F.transform(F.sort_array(F.collect_list(F.struct("d", "q"))), lambda x: x["q"]).alias(name)
    middle = _quantile(binned(grouped, lambda c, i: c), ["g", "d"], 0.5, edge).groupBy("g").agg(as_array("m"))
    around = grouped.join(_salted(middle), ["g", "salt"])
    spread = _quantile(binned(around, lambda c, i: F.abs(c - F.col("m")[i])), ["g", "d"], 0.5, edge).groupBy("g").agg(as_array("d"))
    # 1.4826 median deviations are a standard deviation.
    scale = F.array(*[F.greatest(F.col("d")[i] * 1.4826, F.lit(LEAST[i])) for i in range(_P)])
    centres = stored(middle.join(spread, "g").select("g", "m", scale.alias("d")), "centres")
    narrow = grouped.select("g", "salt", *VECTOR)
    z = F.array(*[(F.col(c) - F.col("m")[i]) / F.col("d")[i] for i, c in enumerate(VECTOR)])
    length = F.greatest(F.sqrt(F.aggregate("z", F.lit(0.0), lambda a, x: a + x * x)), F.lit(1e-9))
    scaled = narrow.join(_salted(centres), ["g", "salt"]).select("g", z.alias("z")).select("g", "z", length.alias("length"))
    tanh, signs = [F.tanh(F.col("z")[i]) for i in range(_P)], [F.col("z")[i] / F.col("length") for i in range(_P)]
    sums = scaled.groupBy("g").agg(F.count("*").alias("n"), _sums(tanh).alias("s"), _products(tanh).alias("ss"), _products(signs).alias("uu"))
    starts = stored(sums.join(centres, "g").mapInPandas(_starts, _ESTIMATE), "starts")
    estimate = stored(least_determinants(narrow, starts), "estimate")
    far = grouped.join(_salted(estimate), ["g", "salt"])
    return far.withColumn("distance", _distance() / CONSISTENCY).drop("g", "salt", "m", "w", *VECTOR)


def judged(docs: DataFrame, key: str, text: str, lang: str, source: str, cutoff: float = CUTOFF) -> DataFrame:
    """Per row: key, COUNTS, base_failed, distance and kept.

    ``base_failed``: fewer than 50 words, or more than half of the words in
    windows of three that repeat. ``kept`` is false for those and for rows beyond
    the cutoff. A null or blank text has no words and fails the base rule. Equal
    rows stay as many rows, and take part in the estimates as such.
    """
    narrow = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(source).alias("source"),
                         text_counts(F.coalesce(F.col(text), F.lit(""))).alias("c"))
    rows = robust_distances(narrow.select("key", "lang", "source", "c.*"), "lang", "source")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("distance") <= cutoff)).withColumnRenamed("key", key)
