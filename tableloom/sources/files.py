"""Readers, writers and file inventories."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"

#: Bytes of a file that one task digests, and that it holds at a time.
BLOCK_BYTES, READ_BYTES = 64 << 20, 1 << 20
#: Bytes of a JSON array that one task parses.
JSON_BLOCK_BYTES = 16 << 20


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csvs(spark: SparkSession, files: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """Several CSV files as named tables: name -> (path, schema)."""
    return {name: read_csv(spark, path, schema) for name, (path, schema) in files.items()}


def ingest_dir(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All CSV files of a folder with the path of the file each row came from."""
    files = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(path)
    return files.withColumn("source_file", F.col("_metadata.file_path"))


def load_csv(spark: SparkSession, path: str, schema: T.StructType, max_errors: int = 100) -> DataFrame:
    """Rows that fit the schema; reading fails when more than ``max_errors`` lines do not.

    Lines are parsed one by one after the header is left out, so which
    columns a query later uses cannot change which lines count as bad.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).filter(F.col("value") != ",".join(schema.names))
    parsed = F.from_csv("value", wide.toDDL(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.select(parsed.alias("r"))
    bad = rows.agg(F.count_if(F.col(f"r.{CORRUPT}").isNotNull())).scalar()
    within = F.when(bad > max_errors, F.raise_error(F.lit(f"more than {max_errors} bad rows")).cast("boolean")).otherwise(F.lit(True))
    return rows.filter(F.col(f"r.{CORRUPT}").isNull() & within).select(*[F.col(f"r.{c}").alias(c) for c in schema.names])


def read_text(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Lines of text files, or records split at ``sep``."""
    reader = spark.read if sep is None else spark.read.option("lineSep", sep)
    return reader.text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, array_files: bool = False) -> DataFrame:
    """JSON lines, or files that each hold one JSON array (``json_elements``)."""
    if not array_files:
        return spark.read.schema(schema).json(path)
    return json_elements(list_files(spark, path)).select(F.from_json("element", schema).alias("r")).select("r.*")


# What the bytes of a JSON text do outside strings; a quote does it anywhere.
_QUOTE, _OPEN, _CLOSE, _COMMA = 1, 2, 3, 4
_KIND = np.zeros(256, np.int8)
for _bytes, _kind in ((b'"', _QUOTE), (b"[{", _OPEN), (b"]}", _CLOSE), (b",", _COMMA)):
    _KIND[list(_bytes)] = _kind


def _backslashes_before(file: pa.NativeFile, at: int) -> int:
    """Length of the run of backslashes that ends before a place of the file."""
    run = 0
    while at > 0:
        span = min(at, 4096)
        file.seek(at - span)
        piece = file.read(span)
        held = span - len(piece.rstrip(b"\\"))
        run += held
        if held < span:
            break
        at -= span
    return run


def _marks(data: bytes, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, kinds and depth steps of the quotes, brackets and commas; ``run`` backslashes come before. Escaped quotes are left out."""
    codes = np.frombuffer(data, np.uint8)
    kinds = _KIND[codes]
    at = np.flatnonzero(kinds)
    kinds = kinds[at]
    quotes = np.flatnonzero(kinds == _QUOTE)
    suspects = quotes[codes[np.maximum(at[quotes] - 1, 0)] == ord("\\")] if len(quotes) else quotes
    if run and len(quotes) and at[quotes[0]] == 0:
        suspects = np.union1d(suspects, quotes[:1])
    keep = np.ones(len(at), bool)
    for i in suspects.tolist():
        j = end = int(at[i])
        while j > 0 and data[j - 1] == ord("\\"):
            j -= 1
        keep[i] = (end - j + (run if j == 0 else 0)) % 2 == 0
    at, kinds = at[keep], kinds[keep]
    return at, kinds, (kinds == _OPEN).astype(np.int64) - (kinds == _CLOSE)


def _cuts(data: bytes, run: int, inside: int, depth: int) -> tuple[list[tuple[int, bool]], int, int]:
    """Where elements of the outermost array end or begin, with whether one begins there; then the state at the end."""
    at, kinds, steps = _marks(data, run)
    within = (np.cumsum(kinds == _QUOTE) + inside) % 2
    steps = np.where(within == 0, steps, 0)
    after = depth + np.cumsum(steps)
    begins = (within == 0) & (after == 1) & ((kinds == _COMMA) | (kinds == _OPEN))
    ends = (steps == -1) & (after == 0)
    found = np.flatnonzero(begins | ends)
    state = (int(within[-1]), int(after[-1])) if len(at) else (inside, depth)
    return list(zip(at[found].tolist(), begins[found].tolist())), *state


def json_elements(files: DataFrame, block: int = JSON_BLOCK_BYTES) -> DataFrame:
    """The elements of files (``path``, ``size``) that each hold one JSON array, as texts: ``path``, ``element``.

    A file is cut into ranges of bytes, which several tasks read. First each range tells what it does to
    a state that runs through the file: whether it turns "inside a string" round, and how
    far it changes the depth of brackets, for either way it may begin. One
    row per range is put together in order, which gives the state each range begins with. Then each
    range gives out the elements that begin in it, reading on to the end of the last one.
    A file of another form, or one that is cut off, is an error.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(block).cast("long"))
    ranges = files.select("path", "size", F.explode(starts).alias("start")).withColumn("span", F.least(F.col("size") - F.col("start"), F.lit(block)))

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = []
            for row in batch.to_pylist():
                with _opened(row["path"]) as file:
                    run = _backslashes_before(file, row["start"])
                    file.seek(row["start"])
                    data = file.read(row["span"])
                if row["start"] == 0 and data.strip()[:1] not in (b"[", b""):
                    raise ValueError(f"{row['path']} is no JSON array")
                _, kinds, steps = _marks(data, run)
                within = np.cumsum(kinds == _QUOTE) % 2
                told.append({**row, "run": run, "turns": int((kinds == _QUOTE).sum() % 2),
                             "outside": int(steps[within == 0].sum()), "inside": int(steps[within == 1].sum())})
            yield pa.RecordBatch.from_pylist(told, pa.schema([(n, batch.schema.field(n).type if n in batch.schema.names else pa.int64()) for n in told[0]]))

    effect = T.StructType([*ranges.schema.fields, *[T.StructField(n, T.LongType()) for n in ("run", "turns", "outside", "inside")]])
    told = ranges.repartition("path", "start").mapInArrow(effects, effect)
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begun = told.withColumn("within", F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2)
    step = F.when(F.col("within") == 0, F.col("outside")).otherwise(F.col("inside"))
    placed = begun.withColumn("step", step).withColumn("depth", F.coalesce(F.sum("step").over(earlier), F.lit(0)))

    def elements_of(row: dict) -> Iterator[str]:
        with _opened(row["path"]) as file:
            at, run, state, begin, parts = row["start"], row["run"], (row["within"], row["depth"]), False, []
            end = at + row["span"]
            while at < end or begin:
                file.seek(at)
                data = file.read(min(READ_BYTES, end - at) if at < end else READ_BYTES)
                if not data:
                    raise ValueError(f"{row['path']} ends inside its array")
                cuts, *state = _cuts(data, run, *state)
                left = 0
                for place, begins in cuts:
                    if begin:
                        text = b"".join([*parts, data[left:place]]).decode()
                        if text.strip():
                            yield text
                    parts, left, begin = [], place + 1, begins and at + place < end
                    if at + place >= end:
                        return
                if begin:
                    parts.append(data[left:])
                held = len(data) - len(data.rstrip(b"\\"))
                run = held + (run if held == len(data) else 0)
                at += len(data)

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts, size = [], 0
                for text in elements_of(row):
                    texts.append(text)
                    size += len(text)
                    if size > READ_BYTES:
                        yield pa.RecordBatch.from_pydict({"path": [row["path"]] * len(texts), "element": texts})
                        texts, size = [], 0
                if texts:
                    yield pa.RecordBatch.from_pydict({"path": [row["path"]] * len(texts), "element": texts})

    return placed.select("path", "start", "span", "run", "within", "depth").repartition("path", "start").mapInArrow(elements, "path string, element string")


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """``timestamp [LEVEL] message`` lines; lines of another form are left out."""
    pattern = r"^(\S+(?: \S+)?) \[(\w+)\] (.*)$"
    text = F.col(column)
    return lines.filter(text.rlike(pattern)).select(
        F.regexp_extract(text, pattern, 1).try_cast("timestamp_ntz").alias("ts"),
        F.regexp_extract(text, pattern, 2).alias("level"),
        F.regexp_extract(text, pattern, 3).alias("message"))


def parse_candidates(records: DataFrame, column: str = "value") -> DataFrame:
    """Records of three lines: ``CANDIDATE n``, ``Experience: y years``, ``Skills: a, b``."""
    text = F.col(column)
    return records.filter(F.trim(text) != "").select(
        F.regexp_extract(text, r"CANDIDATE (\d+)", 1).try_cast("long").alias("candidate"),
        F.regexp_extract(text, r"Experience: (\d+) years", 1).try_cast("int").alias("experience"),
        F.split(F.regexp_extract(text, r"Skills: ([^\n]*)", 1), r",\s*").alias("skills"))


def list_files(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Path below the folder, size and time of every file with a byte in it (Spark lists no others); contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return found.select(name.alias("name"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")) \
        .filter(F.startswith(F.col("name"), F.lit(prefix)))


def store_size(spark: SparkSession, path: str) -> DataFrame:
    size = F.sum("size")
    return list_files(spark, path).agg(
        F.count(F.lit(1)).alias("object_count"), size.alias("total_size_bytes"),
        F.round(size / (1024 * 1024), 4).alias("total_size_mb"))


def _opened(path: str) -> pa.NativeFile:
    """A file by the path that Spark lists it under."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    system, inside = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return system.open_input_file(inside)


def _digested(listed: DataFrame, name: str) -> DataFrame:
    """Add the MD5 of ``span`` bytes from ``start`` on of the file at ``path``, read in pieces, never held whole."""
    schema = T.StructType([*listed.schema.fields, T.StructField(name, T.StringType())])

    def digest(path: str, start: int, span: int) -> str:
        out = md5(usedforsecurity=False)
        with _opened(path) as file:
            file.seek(start)
            while span > 0:
                piece = file.read(min(span, READ_BYTES))
                if not piece:
                    raise OSError(f"{path} is shorter than when it was listed")
                out.update(piece)
                span -= len(piece)
        return out.hexdigest()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [digest(*place) for place in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "span")))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], schema.names)

    return listed.mapInArrow(digests, schema)


def file_hashes(files: DataFrame) -> DataFrame:
    """MD5 of every listed file (``path``, ``size``); a file is read as a stream by one task, since MD5 goes by order."""
    whole = files.select("path", F.col("size").alias("length"), F.lit(0).cast("long").alias("start"), F.col("size").alias("span"))
    return _digested(whole.repartition("path"), "md5").select("path", "length", "md5")


def duplicate_files(files: DataFrame, block: int = BLOCK_BYTES) -> DataFrame:
    """Contents shared by more than one listed file (``path``, ``size``): ``md5``, ``length``, ``copies``, ``first_path`` by name.

    Only files that share their size with another are read. Blocks of bytes are digested
    side by side, also those of one file, and files met by size and the digests of all
    their blocks in order. The MD5 of a shared content is taken from its first file alone.
    """
    alike = files.groupBy("size").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    rivals = files.select("path", "size").join(alike.select("size"), "size", "left_semi")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(block).cast("long"))
    blocks = rivals.withColumn("start", F.explode(starts)).withColumn("span", F.least(F.col("size") - F.col("start"), F.lit(block)))
    told = _digested(blocks.repartition("path", "start"), "digest")
    # One entry per block of a file.
    content = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "digest"))), lambda x: x["digest"]), ""), 256)
    shared = told.groupBy("path", "size").agg(content.alias("content")).groupBy("size", "content") \
        .agg(F.count(F.lit(1)).alias("copies"), F.min("path").alias("path")).filter("copies > 1")
    kept = shared.select("path", "size", "copies", F.lit(0).cast("long").alias("start"), F.col("size").alias("span"))
    return _digested(kept.repartition("path"), "md5").select("md5", F.col("size").alias("length"), "copies", F.col("path").alias("first_path"))


def ingest_text(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files: bytes decoded as UTF-8 with invalid ones left out, size and length."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    text = F.replace(F.make_valid_utf8(F.col("content").cast("string")), F.lit("\ufffd"), F.lit(""))
    return found.select("path", F.col("length").alias("size_bytes"), text.alias("text")) \
        .withColumn("char_count", F.length("text"))


def from_rows(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def save(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    cluster_by: list[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Write a table and return it as read back.

    Clustering spreads rows by range of the cluster columns, so a partition
    value with many rows is written by several tasks.
    """
    partition_by, cluster_by = partition_by or [], cluster_by or []
    if cluster_by:
        df = df.repartitionByRange(*partition_by, *cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
    df.write.mode(mode).format(fmt).partitionBy(*partition_by).save(path)
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Store a query result; calling it again refreshes the stored rows."""
    return save(df, path, "overwrite")


def join_path(*parts: str) -> str:
    return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate(parts))


@dataclass(frozen=True)
class Zones:
    """Paths of the raw, processed and warehouse zones below one root."""

    root: str

    @property
    def raw(self) -> str:
        return join_path(self.root, "raw")

    @property
    def processed(self) -> str:
        return join_path(self.root, "processed")

    @property
    def warehouse(self) -> str:
        return join_path(self.root, "warehouse")

    def table(self, zone: str, name: str) -> str:
        return join_path(getattr(self, zone), name)

