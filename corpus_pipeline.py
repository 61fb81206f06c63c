"""Corpus pipeline: five stages, each reading the stored output of the one before.

A stage takes (spark, docs, sf_dir). Toxic documents go; one document of each near-duplicate group
stays; documents that hold a benchmark item go; secrets are replaced in the text, where n_chars
follows; the last stage gives each document its number of copies in a mix at target weights.
Documents of no copies stay in the result with taken = 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custgraph.llm import decontaminate, minhash, mixing, secrets, toxicity
from custgraph.session import cut_lineage, forget

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = docs.select(*COLUMNS)
    return toxicity.accepted(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs.select(*COLUMNS), words=5, least=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = secrets.redacted(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

ORACLE_SQL = None  # the toxicity model and the edit distances are not SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
        if before is not None:
            forget(before)
        before = docs
    return docs
