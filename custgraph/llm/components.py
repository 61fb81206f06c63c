"""Connected components by alternating stars, each round a stored table; nothing goes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, forget


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbor of a node is tied to the smallest of the node and its neighbors."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("of")).agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where("b > a").join(least, F.col("a") == F.col("of")).select(F.col("least").alias("a"), "b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbor of a node, and the node, is tied to the smallest of them."""
    least = edges.groupBy(F.col("b").alias("of")).agg(F.min("a").alias("least"))
    moved = edges.join(least, F.col("b") == F.col("of")).where("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("least").alias("a"), F.col("of").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b: not null, one type) but the smallest of each component.

    The component is named by its smallest node. Loops and repeated edges are allowed; no edges
    give no rows. The result is a stored table; the caller forgets it.
    """
    state = cut_lineage(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    mark = None
    while True:
        now = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        wide = cut_lineage(_large(state))
        forget(state)
        state = cut_lineage(_small(wide))
        forget(wide)
    result = state.select(F.col("b").alias("node"), F.col("a").alias("component"))
    result.stored_at = state.stored_at
    return result
