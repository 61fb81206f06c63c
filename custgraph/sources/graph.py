"""Scans over the unified node and edge frames of a graph."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_internal(df: DataFrame) -> DataFrame:
    """Without the connector's internal columns, whose names start with ``<``."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith("<")])


def scan_edges(
    edges: DataFrame, source: DataFrame, source_key: str, target: DataFrame, target_key: str
) -> DataFrame:
    """Edges with the properties of both endpoints as ``source.*`` and ``target.*``.

    ``edges`` has the columns ``source.<key>`` and ``target.<key>``.
    """
    def prefixed(df: DataFrame, side: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{side}.{c}") for c in df.columns])

    left, right = prefixed(source, "source"), prefixed(target, "target")
    return edges.join(left, f"source.{source_key}").join(right, f"target.{target_key}")


def discover_schema(edges: DataFrame) -> DataFrame:
    """Every (type, source label, target label) in use, with its number of edges."""
    return edges.groupBy("rel_type", "src_label", "dst_label").agg(F.count(F.lit(1)).alias("edges"))


def labels_in_use(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("label").agg(F.count(F.lit(1)).alias("nodes"))


def beyond_base(df: DataFrame, column: str, base: Iterable[str]) -> DataFrame:
    """Rows whose label or type is not one of the base set; null counts as not base."""
    return df.filter(~F.coalesce(F.col(column).isin(*base), F.lit(False)))


def extract_selected(
    nodes: DataFrame, edges: DataFrame, base_labels: Iterable[str], base_types: Iterable[str], folder: str
) -> DataFrame:
    """Writes what the cycles added to the graph, partitioned by label and type.

    Returns (kind, name, rows, error); one failing table does not stop the other.
    """
    jobs = (
        ("nodes", "label", beyond_base(nodes, "label", base_labels)),
        ("relationships", "rel_type", beyond_base(edges, "rel_type", base_types)),
    )
    spark, parts, failed = nodes.sparkSession, [], []
    for kind, column, df in jobs:
        path = f"{folder}/{kind}"
        try:
            df.write.mode("overwrite").partitionBy(column).parquet(path)
            written = spark.read.schema(df.schema).parquet(path)
            parts.append(
                written.groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("rows"))
                .select(F.lit(kind).alias("kind"), "name", "rows", F.lit(None).cast("string").alias("error"))
            )
        except Exception as problem:
            failed.append((kind, None, 0, str(problem).splitlines()[0]))
    report = spark.createDataFrame(failed, "kind string, name string, rows bigint, error string")
    for part in parts:
        report = report.unionByName(part)
    return report
