"""Shared folder, and array work on the UTF-8 bytes of Arrow text columns.

The byte helpers take a whole Arrow column at once, so no Python string is made
per row. They work through it in pieces of about ``PIECE`` bytes, which bounds
their memory whatever the batch holds; a single longer text is one piece.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

PIECE = 1 << 18
#: Rows and bytes that a task hands to Python at once.
BATCH_ROWS, BATCH_BYTES = 1024, 1 << 22


@cache
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="llm-")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``; a local session without that setting gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = _own_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession) -> None:
    """Hand at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES`` to Python at once in this session: Spark's 10,000 whole
    texts, or its 64 MB, don't fit small workers."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    before = int(spark.conf.get(rows))
    if before <= 0 or before > BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", spark.conf.get(size).lower()).groups()
    before = int(number) << 10 * " kmgtp".index(unit or " ")
    if before <= 0 or before > BATCH_BYTES:
        spark.conf.set(size, f"{BATCH_BYTES}b")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read back: they survive the loss of executors."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, label)
    bounded_batches(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    if n == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]
    return data, offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes, at least one row each."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end
        row = end


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """256 flags, true for the bytes of the inclusive ranges."""
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low: high + 1] = True
    return flags


#: Words between white space, and words of letters, digits and non-ASCII bytes.
SPACED = ~byte_set((0x20, 0x20), (0x09, 0x0D))
ALNUM = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of flagged bytes; a run ends with its row."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[first] = inside[first]
    closes = np.zeros(n + 1, bool)
    closes[1:n] = inside[:-1] & ~inside[1:]
    closes[first] |= np.concatenate([[False], inside])[first]
    closes[n] = inside[-1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes)
    return start, end, np.searchsorted(offsets, start, "right") - 1


_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def _size_class(n: int) -> int:
    return 1 << max(18, int(n).bit_length())


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes: a polynomial of the bytes, scrambled with the length."""
    n, size = len(data), _size_class(len(data))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * _powers(int(_ODD), size)[:n], out=total[1:])
    return mixed((total[end] - total[start]) * _powers(int(_INVERSE), size)[start] + mixed((end - start).astype(np.uint64)))


def shingles(words: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word's index of each window of ``width`` words within a row."""
    if len(words) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = mixed(out * _ODD + words[i: i + n])
    at = np.flatnonzero(row[:n] == row[width - 1:])
    return out[at], at
