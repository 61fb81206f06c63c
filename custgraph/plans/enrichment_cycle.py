"""One enrichment cycle: validate, route, de-duplicate, write graph and log."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.proposals import bucket, deduplicate, validate_proposals
from ..operators.upsert import enrichment_upsert
from ..session import cut_lineage
from ..sources.log import log_rows


@dataclass(frozen=True)
class Cycle:
    """State after a cycle: the given tables plus the stored rows the cycle added, nothing
    rewritten. ``added`` is what goes to the end of the log; nodes and edges go to a snapshot."""

    nodes: DataFrame
    edges: DataFrame
    log: DataFrame
    added: DataFrame
    counts: dict[str, int]


def enrichment_cycle(
    proposals: DataFrame, nodes: DataFrame, edges: DataFrame, log: DataFrame, run_id: str, at: Column | None = None
) -> Cycle:
    """Applies flat proposals to the graph and the log.

    Only high confidence goes on; what the log has is dropped; the log gets exactly the
    proposals whose edge was written, under the timestamp of the edge.
    """
    at = F.lit(datetime.now(timezone.utc)) if at is None else at  # one moment for graph and log
    valid, rejected = validate_proposals(proposals)
    routed = valid.withColumn("bucket", bucket())
    approved = routed.filter(F.col("bucket") == "auto_approve").drop("bucket")
    fresh = cut_lineage(deduplicate(approved, log))
    new_nodes, new_edges, written = enrichment_upsert(fresh, nodes, edges, run_id, at)
    added = cut_lineage(log_rows(written, run_id, at))
    buckets = {r["bucket"]: r["count"] for r in routed.groupBy("bucket").count().collect()}
    counts = {
        "rejected": rejected.count(),
        **{name: buckets.get(name, 0) for name in ("auto_approve", "flagged", "review")},
        "fresh": fresh.count(),
        "written": added.count(),
    }
    return Cycle(new_nodes, new_edges, log.select(*added.columns).unionByName(added), added, counts)
