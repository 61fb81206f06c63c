"""CSV files to typed node tables, and the edge tables derived from them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null
from ..model import EDGES, NODES, EdgeSpec, NodeSpec


def read_csv(spark: SparkSession, folder: str, spec: NodeSpec) -> DataFrame:
    """The file of a node table with every column as text, no inference pass."""
    return spark.read.option("header", True).option("multiLine", False).csv(f"{folder}/{spec.file}")


def typed_nodes(raw: DataFrame, spec: NodeSpec) -> DataFrame:
    """Typed columns of a node table; blanks become null, a bad value fails the job."""
    return raw.select(
        *[blank_to_null(source).cast(kind).alias(name) for source, name, kind in spec.columns()]
    )


def split_rejects(raw: DataFrame, spec: NodeSpec) -> tuple[DataFrame, DataFrame]:
    """(typed rows, raw rows with a value that does not convert and its column names)."""
    typed = [c for c in spec.columns() if c[2] != "string"]
    bad = F.filter(
        F.array(
            *[
                F.when(
                    blank_to_null(source).isNotNull() & blank_to_null(source).try_cast(kind).isNull(),
                    F.lit(source),
                )
                for source, _, kind in typed
            ]
        ),
        lambda c: c.isNotNull(),
    )
    marked = raw.withColumn("bad_columns", bad) if typed else raw.withColumn(
        "bad_columns", F.array().cast("array<string>")
    )
    good = marked.filter(F.size("bad_columns") == 0).select(
        *[blank_to_null(source).try_cast(kind).alias(name) for source, name, kind in spec.columns()]
    )
    return good, marked.filter(F.size("bad_columns") > 0)


def edge_table(nodes: DataFrame, spec: EdgeSpec) -> DataFrame:
    """Two columns, ``source.<key>`` and ``target.<key>``, taken from a node table."""
    return nodes.select(
        F.col(spec.source_column).alias(f"source.{spec.source_key}"),
        F.col(spec.target_column).alias(f"target.{spec.target_key}"),
    )


def edge_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every edge table whose node table is given and carries both columns."""
    out = {}
    for name, spec in EDGES.items():
        nodes = tables.get(spec.from_table)
        if nodes is not None and {spec.source_column, spec.target_column} <= set(nodes.columns):
            out[name] = edge_table(nodes, spec)
    return out


def unified_edges(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All edges as (src, src_label, dst, dst_label, rel_type); ids read ``Label:key``."""
    parts = []
    for name, edges in edge_tables(tables).items():
        spec = EDGES[name]
        source, target = (F.col(f"`{c}`") for c in edges.columns)
        parts.append(
            edges.filter(source.isNotNull() & target.isNotNull()).select(
                F.concat(F.lit(f"{spec.source_label}:"), source).alias("src"),
                F.lit(spec.source_label).alias("src_label"),
                F.concat(F.lit(f"{spec.target_label}:"), target).alias("dst"),
                F.lit(spec.target_label).alias("dst_label"),
                F.lit(spec.rel_type).alias("rel_type"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def unified_nodes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All nodes as (id, label, key)."""
    parts = [
        tables[name].select(
            F.concat(F.lit(f"{spec.label}:"), F.col(spec.key)).alias("id"),
            F.lit(spec.label).alias("label"),
            F.col(spec.key).cast("string").alias("key"),
        )
        for name, spec in NODES.items()
        if name in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame], kind: str) -> DataFrame:
    """(kind, table_name, row_count) with one ``total`` row over the tables."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(kind).alias("kind"), F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    per_table = reduce(DataFrame.unionByName, counts)
    total = per_table.agg(F.sum("row_count").alias("row_count")).select(
        F.lit(kind).alias("kind"), F.lit("total").alias("table_name"), "row_count"
    )
    return per_table.unionByName(total)


def load_all(spark: SparkSession, folder: str, database: str) -> DataFrame:
    """CSV folder to node and edge tables of a database; returns the row counts."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

    def save(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(f"{database}.{name}")
        return spark.table(f"{database}.{name}")

    nodes = {name: save(name, typed_nodes(read_csv(spark, folder, spec), spec)) for name, spec in NODES.items()}
    edges = {name: save(name, df) for name, df in edge_tables(nodes).items()}
    return row_counts(nodes, "node").unionByName(row_counts(edges, "relationship"))


def missing_tables(spark: SparkSession, database: str, expected: Iterable[str] = NODES) -> set[str]:
    """Expected base tables the database does not have; empty means the load can be skipped."""
    if not spark.catalog.databaseExists(database):
        return set(expected)
    return set(expected) - {t.name for t in spark.catalog.listTables(database)}


def describe_tables(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """(table_name, position, column_name, data_type, error) from the catalog."""
    rows = []
    for name in names:
        try:
            fields = spark.table(name).schema.fields
            rows += [(name, i, f.name, f.dataType.simpleString(), None) for i, f in enumerate(fields)]
        except Exception as problem:
            rows.append((name, None, None, None, str(problem).splitlines()[0]))
    schema = T.StructType(
        [
            T.StructField("table_name", T.StringType()),
            T.StructField("position", T.IntegerType()),
            T.StructField("column_name", T.StringType()),
            T.StructField("data_type", T.StringType()),
            T.StructField("error", T.StringType()),
        ]
    )
    return spark.createDataFrame(rows, schema)
