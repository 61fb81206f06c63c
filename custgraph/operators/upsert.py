"""Set-based upserts: each returns the new state of a table, the sink writes it as a snapshot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import deal, salted_join
from ..model import DEDUP_KEY, PROVENANCE, UNIQUE_KEYS
from ..session import keep


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the one with the greatest ``order``; partial aggregation in the map
    tasks makes a key with very many copies as cheap as any other."""
    rest = [c for c in df.columns if c not in keys]
    payload = F.struct(*[F.col(c) for c in rest])
    chosen = df.groupBy(*keys).agg(F.max_by(payload, F.struct(*order)).alias("_row"))
    return chosen.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def _merge(existing: DataFrame, incoming: DataFrame, key: str, how: str) -> DataFrame:
    """Existing and incoming rows side by side by key, incoming columns first where a row came in."""
    new = incoming.withColumn("_in", F.lit(True)).alias("n")
    old = existing.withColumn("_old", F.lit(True)).alias("o")
    came = F.col("n._in").isNotNull()
    columns = []
    for name in [*existing.columns, *[c for c in incoming.columns if c not in existing.columns]]:
        if name == key:
            value = F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}"))
        elif name not in incoming.columns:
            value = F.col(f"o.{name}")
        elif name not in existing.columns:
            value = F.col(f"n.{name}")
        else:
            value = F.when(came, F.col(f"n.{name}")).otherwise(F.col(f"o.{name}"))
        columns.append(value.alias(name))
    action = F.when(F.col("o._old").isNull(), "insert").when(came, "update").otherwise("keep")
    joined = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), how)
    return joined.select(*columns, action.alias("action"))


def upsert_nodes(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows matched by key take every incoming column, null included; the others are added.

    ``incoming`` has one row per key (see :func:`newest_per_key`). ``action`` says what
    happened to each row: keep, update or insert.
    """
    return _merge(existing, incoming, key, "full_outer")


def update_columns(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Existing rows with the incoming columns set where the key matches; adds no rows."""
    return _merge(existing, incoming, key, "left").drop("action")


def write_properties(nodes: DataFrame, values: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Nodes (id, label, ...) with the columns of ``values`` (id, ...) set on the given labels only."""
    chosen = nodes.filter(F.col("label").isin(*labels)).select("id")
    return update_columns(nodes, values.join(chosen, "id", "left_semi"), "id")


def write_predictions(customers: DataFrame, predictions: DataFrame, source: str, at: Column | None = None) -> DataFrame:
    """Customers with the predicted category, its source and time."""
    at = F.current_timestamp() if at is None else at
    incoming = predictions.select(
        "customer_id",
        F.col("predicted_risk_category").alias("risk_category_predicted"),
        F.lit(source).alias("prediction_source"),
        at.alias("prediction_timestamp"),
    )
    return update_columns(customers, incoming, "customer_id")


def upsert_edges(existing: DataFrame, incoming: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (src, dst, rel_type) after adding those whose endpoints both exist.

    Repeats collapse before the endpoint joins; a hot endpoint is spread by salt.
    """
    keys = ["src", "dst", "rel_type"]
    distinct = keep(incoming.select(*keys).distinct())
    ids = nodes.select("id").distinct()
    with_source = salted_join(distinct, ids.withColumnRenamed("id", "src"), "src", ["dst", "rel_type"])
    valid = salted_join(with_source, ids.withColumnRenamed("id", "dst"), "dst", ["src", "rel_type"], measure=distinct)
    tagged = existing.select(*keys, F.lit(0).alias("_new")).unionByName(valid.select(*keys, F.lit(1).alias("_new")))
    return (
        tagged.groupBy(*keys).agg(F.min("_new").alias("_new"))
        .select(*keys, F.when(F.col("_new") == 1, "insert").otherwise("keep").alias("action"))
    )


def unique_key_violations(df: DataFrame, label: str, keys: Sequence[str], rows: int = 0) -> DataFrame:
    """Key values on more than one row; ``rows`` of the table, when known, keep the tasks of one size."""
    value = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (
        deal(df.select(*keys), rows, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
        .select(F.lit(label).alias("label"), value.alias("key_value"), "copies")
    )


def all_key_violations(tables: Mapping[str, DataFrame], rows: Mapping[str, int] | None = None) -> DataFrame:
    """(label, key_value, copies) against the key rule of every label; ``tables`` holds nodes by label, ``rows`` about how many."""
    missing = set(UNIQUE_KEYS) - set(tables)
    if missing:
        raise ValueError(f"no table for {sorted(missing)}")
    known = rows or {}
    return reduce(DataFrame.unionByName, [
        unique_key_violations(tables[label], label, [key], known.get(label, 0)) for label, key in UNIQUE_KEYS.items()
    ])


def flat_edges(proposals: DataFrame, run_id: str, at: Column) -> DataFrame:
    """Proposals as graph edges with provenance; the later one wins on the same edge."""
    edges = proposals.select(
        F.concat_ws(":", "source_label", "source_key_value").alias("src"),
        F.concat_ws(":", "target_label", "target_key_value").alias("dst"),
        F.col("relationship_type").alias("rel_type"),
        "target_label", "target_key_value",
        *[F.col(c) for c in ("confidence", "source_document", "extracted_phrase", "properties", "proposed_at")],
    )
    latest = newest_per_key(
        edges, ["src", "dst", "rel_type"], [F.col("proposed_at"), F.col("source_document")]
    )
    return latest.drop("proposed_at").withColumns(
        {"enrichment_timestamp": at.cast("timestamp"), "run_id": F.lit(run_id)}
    )


def writeback_plan(proposals: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """What a write would do per distinct proposal, without writing.

    (src, dst, rel_type, target_action, edge_action): the source must exist, a missing
    target is created, an existing edge is updated.
    """
    wanted = keep(
        proposals.select(
            F.concat_ws(":", "source_label", "source_key_value").alias("src"),
            F.concat_ws(":", "target_label", "target_key_value").alias("dst"),
            F.col("relationship_type").alias("rel_type"),
        ).distinct()
    )
    ids = nodes.select("id").distinct()
    checked = salted_join(
        wanted, ids.select(F.col("id").alias("src"), F.lit(True).alias("_src")), "src", ["dst"], "left"
    )
    checked = salted_join(
        checked, ids.select(F.col("id").alias("dst"), F.lit(True).alias("_dst")), "dst", ["src"], "left",
        measure=wanted,
    )
    known = edges.select("src", "dst", "rel_type").distinct().withColumn("_edge", F.lit(True))
    checked = checked.join(known, ["src", "dst", "rel_type"], "left")
    found = F.col("_src").isNotNull()
    return checked.select(
        "src", "dst", "rel_type",
        F.when(~found, "none").when(F.col("_dst").isNull(), "insert_node").otherwise("match_node").alias("target_action"),
        F.when(~found, "skip").when(F.col("_edge").isNull(), "insert_edge").otherwise("update_edge").alias("edge_action"),
    )


def enrichment_upsert(
    proposals: DataFrame, nodes: DataFrame, edges: DataFrame, run_id: str, at: Column | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, proposals really written) after one run.

    A proposal with an unknown source writes nothing; a missing target becomes a node;
    edges carry the provenance and the custom properties.
    """
    at = F.current_timestamp() if at is None else at
    known = nodes.select(F.col("id").alias("src")).distinct()
    flat = keep(flat_edges(proposals, run_id, at))
    incoming = keep(salted_join(flat, known, "src", ["dst", "rel_type"]))
    targets = incoming.select(
        F.col("dst").alias("id"), F.col("target_label").alias("label"), F.col("target_key_value").alias("key")
    ).distinct()
    new_nodes = nodes.select("id", "label", "key").unionByName(
        targets.join(nodes.select("id"), "id", "left_anti")
    )
    shape = ["src", "dst", "rel_type", *PROVENANCE, "properties"]
    old = edges.join(incoming.select("src", "dst", "rel_type"), ["src", "dst", "rel_type"], "left_anti")
    for name in shape:
        if name not in old.columns:
            kind = incoming.schema[name].dataType
            old = old.withColumn(name, F.lit(None).cast(kind))
    new_edges = old.select(*shape).unionByName(incoming.select(*shape))
    with_id = proposals.withColumn("src", F.concat_ws(":", "source_label", "source_key_value"))
    written = salted_join(with_id, known, "src", list(DEDUP_KEY)).drop("src")
    return new_nodes, new_edges, written
