"""Session settings and lineage cutting shared by every job."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

LOCAL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("custgraph")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for name, value in LOCAL_SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_scratch: dict[str, str] = {}  # application id -> folder of a local session that names none


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, as the session names it.

    A cluster must name a folder that all executors see; only a local master, whose
    executors share the driver's disk, falls back to one scratch folder for each application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    application = spark.sparkContext.applicationId
    if application not in _scratch:
        _scratch[application] = f"file://{tempfile.mkdtemp(prefix='custgraph-')}"
    return _scratch[application]


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: its history is forgotten, its size
    is known, and a lost executor costs nothing that was computed before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/custgraph-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def forget(df: DataFrame) -> None:
    """Deletes what :func:`cut_lineage` wrote for ``df``; nothing may read it any more."""
    path = getattr(df, "stored_at", None)
    if path is not None:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def keep(df: DataFrame) -> DataFrame:
    """Cache a frame read several times; blocks lost with an executor are recomputed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
