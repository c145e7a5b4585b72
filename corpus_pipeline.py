"""Corpus cleaning pipeline over ``documents``, stage by stage.

Each stage reads the Parquet table its predecessor wrote, calls one operator of
``voltaflow.llm`` and lets that operator's decisions take effect. All stages but
the last return the columns of ``documents``; rows with nulls, empty texts and
repeated rows pass like any other (an empty text is one more near duplicate).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaflow.llm import bpe, decontaminate, pii, simhash, toxicity
from voltaflow.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(F.col("text"), model) < 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id."""
    return simhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the new text."""
    out = docs.withColumn("text", pii.redact(F.col("text")))
    size = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return out.withColumn("n_chars", size).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether their bytes decode to the text again."""
    model = bpe.serialise(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    coded = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"),
                        bpe.encode(F.col("text"), model, public_tokenizers.PATTERN).alias("ids"))
    back = F.decode(bpe.decode(F.col("ids"), model), "UTF-8")
    return coded.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids",
                        (back == F.col("text")).alias("round_trip"))


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_dedup", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("pii", private_data),
    ("bpe", tokens),
]

#: The classifier, the fingerprints and the searches are not SQL; the tests
#: compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each written as Parquet and reread."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
