"""Undirected projections of a property graph and the adjacency the algorithms share."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import SLICE_ROWS, copy_rows, global_rank, slice_rows
from ..session import cut_lineage, keep


@dataclass(frozen=True)
class Projection:
    """Chosen nodes (id, label) and edges (src, dst, rel_type); ``directed`` has every edge both ways."""

    nodes: DataFrame
    forward: DataFrame

    @property
    def directed(self) -> DataFrame:
        rest = [c for c in self.forward.columns if c not in ("src", "dst")]
        backward = self.forward.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *rest)
        return self.forward.unionByName(backward)


def project(
    nodes: DataFrame, edges: DataFrame, labels: Iterable[str] | None = None,
    types: Iterable[str] | DataFrame | None = None,
) -> Projection:
    """Nodes of the chosen labels and edges of the chosen types between them.

    ``edges`` has (src, src_label, dst, dst_label, rel_type), one row per edge; ``types``
    may be a frame of type names, as the enrichment log gives them.
    """
    if labels is not None:
        labels = list(labels)
        nodes = nodes.filter(F.col("label").isin(labels))
        edges = edges.filter(F.col("src_label").isin(labels) & F.col("dst_label").isin(labels))
    if isinstance(types, DataFrame):
        edges = edges.join(types.toDF("rel_type").distinct(), "rel_type", "left_semi")
    elif types is not None:
        edges = edges.filter(F.col("rel_type").isin(list(types)))
    return Projection(nodes.select("id", "label"), edges.select("src", "dst", "rel_type"))


def number_nodes(graph: Projection) -> tuple[DataFrame, DataFrame]:
    """(names (id, name, label), directed edges (src, dst)) with a number for every node.

    The numbers follow the order of the names, so the smallest number is the smallest
    name. Rounds then shuffle 8-byte keys instead of texts. Both joins feed another
    shuffle, which lets Spark split the rows of a hub by itself.
    """
    ranked = global_rank(graph.nodes.select(F.col("id").alias("name"), "label"), "name", name="id")
    names = keep(ranked.select("id", "name", "label"))
    source = names.select(F.col("name").alias("src"), F.col("id").alias("_s"))
    target = names.select(F.col("name").alias("dst"), F.col("id").alias("_t"))
    coded = graph.forward.select("src", "dst").join(source, "src").join(target, "dst")
    stored = cut_lineage(coded.select(F.col("_s").alias("src"), F.col("_t").alias("dst")))  # both ways and degrees read it
    return names, Projection(names, stored).directed


def projection_counts(graph: Projection) -> DataFrame:
    """Nodes per label and directed rows per type, as (kind, name, rows)."""
    nodes = graph.nodes.groupBy(F.col("label").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    edges = graph.directed.groupBy(F.col("rel_type").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    return nodes.select(F.lit("node").alias("kind"), "name", "rows").unionByName(
        edges.select(F.lit("relationship").alias("kind"), "name", "rows")
    )


def node_degree(graph: Projection) -> DataFrame:
    """Every node with the number of its directed rows, 0 for isolated ones."""
    ends = graph.forward.select(F.explode(F.array("src", "dst")).alias("id"))  # the edges are made once, not for each end
    degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    return graph.nodes.join(degree, "id", "left").select("id", "label", F.coalesce("degree", F.lit(0)).alias("degree"))


class Adjacency:
    """Edges (src, dst, w) laid out once by source and read in every round.

    Values travel from ``src`` to ``dst``: a round joins the current value of each node
    to its edges and aggregates by ``dst``, partial sums first. Nodes with more than
    ``per_slice`` edges are cut into slices and their value is copied per slice, so a hub
    is never one task; without hubs the salt is left out and nothing is copied.
    """

    def __init__(self, edges: DataFrame, per_slice: int = SLICE_ROWS) -> None:
        self.degree = keep(edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree")))
        large = self.degree.filter(F.col("degree") > per_slice)
        self.hot = keep(
            large.select(F.col("id").alias("key"), F.ceil(F.col("degree") / per_slice).cast("int").alias("fan"))
        )
        self.sliced = not self.hot.isEmpty()
        width = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        if self.sliced:
            salted = slice_rows(edges, "src", self._hot_as("src"), ["dst"])
            self.edges = keep(salted.repartition(width, "src", "salt").sortWithinPartitions("src", "salt"))
        else:
            self.edges = keep(edges.repartition(width, "src").sortWithinPartitions("src"))

    def _hot_as(self, name: str) -> DataFrame:
        return self.hot.withColumnRenamed("key", name)

    def send(self, values: DataFrame) -> DataFrame:
        """Edges with the columns of ``values`` (id, ...) of their source."""
        named = values.withColumnRenamed("id", "src")
        if not self.sliced:
            return self.edges.join(named, "src")
        return self.edges.join(copy_rows(named, "src", self._hot_as("src")), ["src", "salt"]).drop("salt")

    def join_node(self, rows: DataFrame, values: DataFrame, spread_by: str) -> DataFrame:
        """``rows`` (id, ...) with the columns of ``values`` (id, ...); rows of hubs are sliced."""
        if not self.sliced:
            return rows.join(values, "id")
        hot = self._hot_as("id")
        left, right = slice_rows(rows, "id", hot, [spread_by]), copy_rows(values, "id", hot)
        return left.join(right, ["id", "salt"]).drop("salt")

    def release(self) -> None:
        for frame in (self.edges, self.hot, self.degree):
            frame.unpersist()
