"""What the physical plans may and may not contain."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
PYTHON_ALLOWED: set[str] = set()
RELATIONAL = (
    "sector_exposure", "portfolio_holdings", "portfolio_context", "account_summary", "structuring_accounts", "flow_rings",
    "coordinated_positions", "suspicious_communities", "proposal_dedup", "enrichment_upsert", "upsert_edges", "writeback_plan",
    "html_sections", "chunk_fixed", "chunk_postings", "describes_edges", "create_holdout", "stratified_folds", "node_degree",
    "vector_topk", "feature_table",
)


def plan_of(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_python_and_no_cartesian(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_ALLOWED:
        assert "Python" not in plan and "MapInPandas" not in plan


def test_amount_band_reaches_the_scan(spark):
    plan = plan_of(spark, "structuring_accounts")
    assert re.search(r"DataFilters: \[isnotnull\(l_extendedprice#\d+\), \(l_extendedprice#\d+ >= 8000.0\)", plan)
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThanOrEqual(l_ext" in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(spark, "sector_exposure")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in plan


def test_top_k_is_cut_before_the_shuffle(spark):
    assert plan_of(spark, "create_holdout").count("WindowGroupLimit") >= 2


def test_fastrp_sums_run_in_generated_code(spark):
    """A round at 128 dimensions: every aggregate and the exchange before it, in blocks of 32 columns."""
    from custgraph.graph.fastrp import BLOCK, _sign, round_means
    from custgraph.graph.projection import Adjacency

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        edges = spark.createDataFrame([(0, 1), (1, 0), (1, 2), (2, 1)], "src long, dst long")
        state = spark.range(3).selectExpr("id", "cast(id as string) as name", "explode(sequence(0, 3)) as block").selectExpr(
            "id", "block", *[f"{_sign(1, j)} as x{j}" for j in range(BLOCK)]
        )
        means = round_means(Adjacency(edges), state, BLOCK)
        plan = means._jdf.queryExecution().executedPlan().toString()
        lines = [line for line in plan.splitlines() if "HashAggregate" in line or "Join" in line]
        assert lines and all("*(" in line for line in lines)
        assert means.count() == 3 * 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name, times", [("node_degree", 1), ("portfolio_context", 2)])
def test_line_items_are_read_no_oftener_than_needed(spark, name, times):
    assert plan_of(spark, name).count("lineitem.parquet") == times


def test_key_rules_and_positions_are_dealt_by_size(spark, monkeypatch):
    monkeypatch.setattr("custgraph.functions.skew.DEAL_ROWS", 500)
    for name in ("all_key_violations", "unique_key_violations", "node_degree", "portfolio_context"):
        assert "REPARTITION_BY_NUM" in plan_of(spark, name)
