"""Token files: ids of documents in key order, coded in checksummed blocks.

A file holds segments, rows of whole documents with about ``SEGMENT`` ids. A
segment lists its documents' keys and numbers of ids, and the blocks that hold
their ids in order; each block has a checksum, and a segment's blocks share their
statistics. Segments know their part (the range of keys that one task wrote) and
the ids before them in it, so that any segment can be read alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.coder import packed_blocks, unpacked_blocks
from tableloom.llm.common import stored
from tableloom.llm.tokens import _encoder

#: Ids of a segment, about, and chunks of text whose ids a worker remembers.
SEGMENT, CHUNKS = 4 << 20, 1_500_000
_BLOCK = pa.struct([("n", pa.int32()), ("check", pa.int64()), ("payload", pa.binary())])


def _writer(tokenizer: str, end: int):
    schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())),
                        ("sizes", pa.list_(pa.int64())), ("blocks", pa.list_(_BLOCK))])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, last = _encoder(tokenizer, CHUNKS), TaskContext.get().partitionId(), np.array([end], "<u4").tobytes()
        before, keys, held, size = 0, [], [], 0

        def segment() -> pa.RecordBatch:
            blocks = packed_blocks(np.frombuffer(b"".join(held), "<u4"))
            row = {"part": part, "before": before, "n": size, "keys": keys, "sizes": [len(x) // 4 for x in held],
                   "blocks": [{"n": n, "check": c, "payload": p} for n, c, p in blocks]}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1))):
                keys.append(key)
                held.append(ids + last)
                size += len(held[-1]) // 4
                if size >= SEGMENT:
                    yield segment()
                    before, keys, held, size = before + size, [], [], 0
        if keys:
            yield segment()

    return write


def write(docs: DataFrame, key: str, text: str, tokenizer: str, end: int = 0) -> DataFrame:
    """The files' segments, written to the shared folder and opened again.

    Documents are in ascending order of key, null keys first; rows of one key in
    the order of the table. A null or empty text is the end id alone. An empty
    table gives no segment.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("key", "row").sortWithinPartitions("key", "row").select("key", "text")
    return stored(ordered.mapInArrow(
        _writer(tokenizer, end), "part int, before long, n long, keys array<long>, sizes array<long>, blocks array<struct<n: int, check: long, payload: binary>>"), "tokens")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            part, before, keys, sizes = (batch.column(i)[row].as_py() for i in range(4))
            blocks = batch.column(4)[row].values.flatten()
            raw = np.concatenate(unpacked_blocks(list(zip(*(b.to_pylist() for b in blocks))))).tobytes()
            edge = np.concatenate([[0], np.cumsum(sizes)])
            for low in range(0, len(keys), 1024):
                high = min(low + 1024, len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[low:high], pa.int64()), pa.array([part] * (high - low), pa.int32()), pa.array(edge[low:high] + before),
                     pa.array(sizes[low:high], pa.int64()), pa.array([raw[4 * edge[i]: 4 * edge[i + 1]] for i in range(low, high)], pa.binary())],
                    ["key", "part", "at", "n_tokens", "ids"])


def read(segments: DataFrame) -> DataFrame:
    """Per document: key, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit).

    A block that doesn't have its checksum fails the read.
    """
    # As many rows as tasks wrote files.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = segments.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("base"))
    rows = segments.select("part", "before", "keys", "sizes", "blocks").mapInArrow(_read, "key long, part int, at long, n_tokens long, ids binary")
    return rows.join(F.broadcast(parts), "part").select("key", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")
