"""The corpus pipeline: stages over ``documents``, each calling one operator
of ``rolefeed.llm``, written as Parquet and read again before the next."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolefeed.llm import decontaminate, language_id, line_dedup, packing, simhash
from rolefeed.llm.common import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


BATCH_ROWS = 500  # whole texts that a Python worker is handed at a time


def small_batches(spark: SparkSession) -> None:
    """Documents are long: the session's Arrow batches are made BATCH_ROWS rows,
    if they are larger, so that two workers and the JVM fit into an executor."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents of no language (no text or no letter) go."""
    small_batches(spark)
    predicted = language_id.predict(docs, language_id.learn(docs))
    return predicted.where(F.col("lang_pred") != language_id.UNKNOWN).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of like lines one occurrence stays; ``n_chars``
    follows the text. A document whose lines all stand elsewhere has an empty
    text from here on."""
    small_batches(spark)
    left = line_dedup.dedup_lines(docs, sampled=True)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each SimHash group (word triples, 3 bits) stays."""
    small_batches(spark)
    return simhash.one_of_each_group(docs, shingle=3, max_bits=3).select(*COLUMNS)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that share a template window with a benchmark item go."""
    small_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: every piece of every document and its place in a sequence."""
    small_batches(spark)
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=1024)
    return packed.placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash", near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("packing", pack),
]

#: SQL cannot state a learnt, a SimHash or a token stage; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
