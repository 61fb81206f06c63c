"""Reports in their order: a position for every row, from a range-partitioned sort, never one sorted task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import global_rank
from .context import LINE_ORDER
from .proposals import prior_enrichment_lines

# The order of each report, then columns that break ties. A minus sign is falling order; nulls come last.
REPORT_ORDER = {
    "suspicious_communities": ("-account_count", "community_id", "bank_id", "account_id"),
    "structuring_accounts": ("-structuring_count", "account_id"),
    "flow_edges": ("community_id", "from_account", "to_account"),
    "coordinated_positions": ("market_cap_billions", "community_id", "stock_id", "account_id"),
    "combined_risk": ("-risk_score", "account_id", "customer_id"),
    "portfolio_holdings": ("customer_id", "sector", "ticker", "position_id"),
    "customer_profiles": ("customer_id",),
    "portfolio_context": (*LINE_ORDER, "line"),
}

# First and last line of the report on earlier enrichments.
PRIOR_TITLE = "## Prior Enrichments (already written to graph)"
PRIOR_ADVICE = (
    "Do NOT re-propose relationships that already appear above. Focus on discovering new gaps and patterns."
)


def in_order(report: DataFrame, name: str) -> DataFrame:
    """``report`` with the ``position`` of each row in the order of the report ``name``."""
    order = [
        F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in REPORT_ORDER[name]
    ]
    return global_rank(report, *order, name="position")


def prior_report(log: DataFrame) -> DataFrame:
    """(position, line): the log as a whole text, types and sources in order; an empty log gives no lines."""
    lines = prior_enrichment_lines(log)
    order = [F.col(c) for c in LINE_ORDER]
    blank = log.select("relationship_type").distinct().select(
        F.lit(1).alias("place"), F.lit("5_prior").alias("section"), F.col("relationship_type").alias("group_key"),
        F.lit(2).alias("block"), F.lit("").alias("sub_key"), F.lit("").alias("item_key"), F.lit("").alias("line"),
    )
    frame = log.limit(1).select(F.explode(F.array(
        *[F.struct(F.lit(place).alias("place"), F.lit(block).alias("block"), F.lit(line).alias("line"))
          for place, block, line in ((0, 0, PRIOR_TITLE), (0, 1, ""), (2, 0, PRIOR_ADVICE), (2, 1, ""))]
    )).alias("f")).select("f.place", F.lit("5_prior").alias("section"), F.lit("").alias("group_key"), "f.block",
                          F.lit("").alias("sub_key"), F.lit("").alias("item_key"), "f.line")
    whole = lines.select(F.lit(1).alias("place"), *order, "line").unionByName(blank).unionByName(frame)
    return global_rank(whole, "place", *order, "line", name="position").select("position", "line")


def enrichment_totals(log: DataFrame) -> DataFrame:
    """(relationship_type, rows) of the log, and the number of all rows with the type null."""
    known = F.coalesce("relationship_type", F.lit(""))
    return log.rollup(known.alias("relationship_type")).agg(F.count(F.lit(1)).alias("rows"))
