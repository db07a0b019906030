"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.llm import decontam, language, neardup, packing, pii
from tableloom.llm.common import bounded_batches, stored, unused
from tableloom.llm.queries import vocabulary


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the rest goes."""
    bounded_batches(spark)
    models = language.learned(docs, "doc_id", "text", "lang")
    name = unused(docs, "__found")
    found = language.with_language(docs, models, "text", name)
    return found.filter(language.accepted(name, "text")).drop(name)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity of 0.8 or more."""
    return neardup.deduplicated(docs, "doc_id", "text", neardup.LOOSE)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.clean(docs, "doc_id", "text", bench, "item_id", "text")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind."""
    bounded_batches(spark)
    tagger = pii.train(pii.training_sample(docs, "doc_id", "text"))
    name = unused(docs, "__found")
    found = docs.withColumn(name, pii.spans(F.col("text"), tagger))
    clean = found.withColumn("text", pii.masked(F.col("text"), F.col(name)))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids and their place in sequences of 2048 tokens."""
    cut = packing.pieces(docs, "doc_id", "text", vocabulary("word_bpe_49k.json"), end=1)
    placed = packing.packed(cut)
    return placed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("language", in_known_language),
    ("near-duplicates", without_near_duplicates),
    ("benchmark", without_benchmark),
    ("personal data", without_personal_data),
    ("packing", packed_sequences),
]

#: Learned models and tokenizers take part, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
