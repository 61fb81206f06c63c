"""The fraud report: graph scores on the accounts, every pattern, and the sections as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..graph.louvain import louvain
from ..graph.pagerank import pagerank
from ..graph.projection import Projection
from ..graph.similarity import CUTOFF, TOP_K, max_similarity, node_similarity
from ..operators import fraud
from ..session import keep
from ..sources.files import write_report


def score_accounts(
    graph: Projection, accounts: DataFrame, node_id: str, label: str = "Account", cutoff: float = CUTOFF, top_k: int = TOP_K
) -> DataFrame:
    """Accounts with risk_score (PageRank), community_id (Louvain) and similarity_score (best
    Jaccard similarity on either end); ``node_id`` is the account column that holds the node id."""
    of_label = F.col("label") == label
    scores = pagerank(graph).scores.filter(of_label).select(F.col("id").alias(node_id), F.col("score").alias("risk_score"))
    communities = louvain(graph).communities.filter(of_label).select(F.col("id").alias(node_id), "community_id")
    similar = max_similarity(node_similarity(graph, cutoff, top_k)).withColumnRenamed("id", node_id)
    known = accounts.drop("risk_score", "community_id", "similarity_score")
    return known.join(scores, node_id, "left").join(communities, node_id, "left").join(similar, node_id, "left")


def fraud_sections(
    customers: DataFrame, accounts: DataFrame, banks: DataFrame, transactions: DataFrame,
    positions: DataFrame, stocks: DataFrame, companies: DataFrame, min_accounts: int = fraud.MIN_GROUP,
) -> dict[str, DataFrame]:
    """Section name to frame. Frames that several sections read are cached."""
    structuring = keep(fraud.structuring_accounts(accounts, transactions))
    transfers = keep(fraud.community_transfers(accounts, transactions))
    rings = keep(fraud.flow_rings(transfers))
    stock_groups = keep(fraud.position_groups(accounts, positions, stocks, companies))
    coordinated = fraud.position_members(accounts, positions, stock_groups)
    bank_groups = fraud.community_bank_groups(accounts, min_accounts)
    communities = fraud.suspicious_communities(accounts, banks, min_accounts)
    signals = keep(fraud.risk_signals(structuring, rings, coordinated))
    combined = fraud.combined_risk(signals, customers, accounts)
    flows = fraud.flow_edges(transfers)
    return {
        "summary": fraud.fraud_summary(bank_groups, structuring, flows, rings, stock_groups, combined),
        "suspicious_communities": communities,
        "structuring_accounts": structuring,
        "circular_flow_edges": flows,
        "circular_flow_rings": rings,
        "coordinated_positions": coordinated,
        "risk_signals": signals,
        "combined_risk": combined,
    }


def write_fraud_report(sections: dict[str, DataFrame], folder: str) -> None:
    write_report(sections, folder)
