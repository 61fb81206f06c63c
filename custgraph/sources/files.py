"""Document files: embeddings JSON, HTML, result files of earlier runs, and text sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import EMBEDDINGS_FILE, PROPOSAL


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EMBEDDINGS_FILE).option("multiLine", True).json(path)


def document_rows(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.explode("documents").alias("d")).select("d.*")


def chunk_rows(embeddings: DataFrame) -> DataFrame:
    """One row per chunk with its metadata fields as columns."""
    return embeddings.select(F.explode("chunks").alias("c")).select(
        "c.chunk_id", "c.index", "c.text", "c.document_id", "c.metadata.*", "c.embedding"
    )


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """(filename, html), one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.element_at(F.split(F.input_file_name(), "/"), -1).alias("filename"),
        F.col("value").alias("html"),
    )


def read_proposal_files(spark: SparkSession, path: str) -> DataFrame:
    """Proposals of ``instance_proposals_*.json``: three lists become rows with a bucket."""
    buckets = ("auto_approve", "flagged", "review")
    schema = ", ".join(f"{b} array<{PROPOSAL.simpleString()}>" for b in buckets)
    files = spark.read.schema(schema).option("multiLine", True).json(path)
    none = F.array().cast(f"array<{PROPOSAL.simpleString()}>")

    def tagged(name: str) -> Column:
        mark = F.lit(name).alias("bucket")
        return F.transform(F.coalesce(F.col(name), none), lambda p: F.struct(mark, p.alias("proposal")))

    rows = F.flatten(F.array(*[tagged(b) for b in buckets]))
    return files.select(F.explode(rows).alias("t")).select("t.bucket", "t.proposal.*")


def write_lines(lines: DataFrame, path: str, *order: Column | str) -> None:
    """Text lines in total order: a range-partitioned sort, one file per range."""
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)


def write_report(sections: dict[str, DataFrame], folder: str) -> None:
    """Each report section as JSON rows under its own name."""
    for name, df in sections.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")
