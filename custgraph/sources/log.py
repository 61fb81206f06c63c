"""The append-only enrichment log and snapshot tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import ENRICHMENT_LOG


def ensure_log(spark: SparkSession, table: str) -> None:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ENRICHMENT_LOG)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")


def log_rows(proposals: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    """Proposals in the shape of the log; custom properties become JSON text."""
    at = F.current_timestamp() if at is None else at
    named = proposals.withColumns(
        {
            "run_id": F.lit(run_id),
            "enrichment_timestamp": at.cast("timestamp"),
            "properties_json": F.to_json(
                F.coalesce(F.col("properties"), F.create_map().cast("map<string,string>"))
            ),
        }
    )
    return named.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ENRICHMENT_LOG])


def append_log(proposals: DataFrame, table: str, run_id: str) -> int:
    """Appends one run to the log and returns its rows; an empty batch, or a run already
    in the log, writes nothing, so a retry of the whole run is safe."""
    spark = proposals.sparkSession
    done = not spark.table(table).filter(F.col("run_id") == run_id).isEmpty()
    if not done and not proposals.isEmpty():
        log_rows(proposals, run_id).write.mode("append").insertInto(table)
    return 0 if done else spark.table(table).filter(F.col("run_id") == run_id).count()


def write_snapshot(df: DataFrame, root: str) -> str:
    """Writes a new version beside the old ones, then points to it; readers of the old
    version are not disturbed and a failed write leaves the pointer where it was."""
    spark = df.sparkSession
    version = uuid.uuid4().hex[:12]
    df.write.mode("errorifexists").parquet(f"{root}/version={version}")
    spark.range(1).select(
        F.lit(version).alias("version"), F.current_timestamp().alias("published_at")
    ).write.mode("append").parquet(f"{root}-pointer")
    return version


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The version published last."""
    newest = spark.read.parquet(f"{root}-pointer").agg(F.max_by("version", "published_at")).first()[0]
    return spark.read.parquet(f"{root}/version={newest}")
