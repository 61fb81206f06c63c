"""A planted ring of five accounts at one bank must be found by every pattern."""

import pytest
from pyspark.sql import functions as F

from custgraph.operators import fraud
from custgraph.plans.fraud_report import fraud_sections, score_accounts, write_fraud_report
from custgraph.graph.projection import project

RING = [f"R{i}" for i in range(5)]
OTHERS = [f"N{i}" for i in range(6)]


@pytest.fixture
def world(spark):
    accounts = spark.createDataFrame(
        [(a, f"C{a}", "Checking", "B1", "ring", 2.0, 0.9) for a in RING]
        + [(a, f"C{a}", "Savings", f"B{i}", "rest" if i % 2 else None, 1.0, None) for i, a in enumerate(OTHERS)],
        "account_id string, customer_id string, account_type string, bank_id string, community_id string,"
        "risk_score double, similarity_score double",
    )
    customers = spark.createDataFrame(
        [(f"C{a}", "F", a, 50000, 700) for a in [*RING[:4], *OTHERS]],
        "customer_id string, first_name string, last_name string, annual_income int, credit_score int",
    )
    rows = [(RING[i], RING[(i + 1) % 5], 8000.0 + 10 * n, f"2024-01-{n + 1:02d}") for i in range(5) for n in range(8)]
    rows += [("N0", "N1", 8500.0, "2024-02-01"), ("N0", "N1", 10000.0, "2024-02-02"), ("N0", "N1", 7999.99, "2024-02-03")]
    transactions = spark.createDataFrame(
        rows, "from_account_id string, to_account_id string, amount double, transaction_date string"
    )
    positions = spark.createDataFrame(
        [(a, s) for a in RING for s in ("S1", "S2")] + [("N1", "S1"), ("N3", "S9")], "account_id string, stock_id string"
    )
    stocks = spark.createDataFrame(
        [("S1", "LOW", "K1", 0.5), ("S2", "TINY", "K2", 0.25), ("S9", "BIG", "K3", 100.0)],
        "stock_id string, ticker string, company_id string, market_cap_billions double",
    )
    companies = spark.createDataFrame([("K1", "Low Co"), ("K2", "Tiny Co"), ("K3", "Big Co")], "company_id string, name string")
    banks = spark.createDataFrame([(f"B{i}", f"Bank {i}") for i in range(6)], "bank_id string, name string")
    return customers, accounts, banks, transactions, positions, stocks, companies


def test_ring_is_found_everywhere(world, tmp_path):
    sections = fraud_sections(*world)
    size = {r["section"]: r["entries"] for r in sections["summary"].collect()}
    assert size == {
        "suspicious_communities": 1, "structuring_accounts": 5, "circular_flow_edges": 5, "circular_flow_rings": 1,
        "coordinated_positions": 2, "flagged_accounts": 4, "flagged_customers": 4,
    }
    assert {r["account_id"] for r in sections["circular_flow_rings"].collect()} == set(RING)
    top = {r["account_id"]: r for r in sections["combined_risk"].collect()}
    assert set(top) == set(RING[:4])  # the fifth has no owner
    assert top["R0"]["signal_count"] == 4 and top["R0"]["position_signals"] == 2
    assert top["R0"]["structuring"] == "structuring: 8 txns, avg $8,035.00"
    assert top["R0"]["circular_flow"] == "circular_flow: 5-account ring"
    texts = {r["signal"] for r in sections["risk_signals"].filter("account_id = 'R0'").collect()}
    assert "coordinated_position: TINY ($0.25B mcap)" in texts
    write_fraud_report(sections, str(tmp_path / "report"))
    assert {p.name for p in (tmp_path / "report").iterdir()} == set(sections)


def test_band_is_half_open(spark):
    df = spark.createDataFrame([(7999.99,), (8000.0,), (9999.99,), (10000.0,)], "amount double")
    assert [r["amount"] for r in fraud.in_band(df).orderBy("amount").collect()] == [8000.0, 9999.99]


def test_position_alone_does_not_flag(world):
    customers, accounts, banks, transactions, positions, stocks, companies = world
    calm = transactions.filter(F.col("from_account_id").startswith("N"))
    sections = fraud_sections(customers, accounts, banks, calm, positions, stocks, companies)
    assert not sections["coordinated_positions"].isEmpty()
    assert sections["combined_risk"].isEmpty() and sections["risk_signals"].isEmpty()


def test_property_coverage_counts_nulls(world):
    row = fraud.property_coverage(world[1]).first()
    assert (row["total_accounts"], row["with_community"], row["with_similarity"], row["communities"]) == (11, 8, 5, 2)


def test_scores_come_from_the_graph(spark, world):
    accounts = world[1].select("account_id", "customer_id").withColumn("node", F.col("account_id"))
    nodes = accounts.select(F.col("node").alias("id"), F.lit("Account").alias("label"))
    edges = world[3].select(
        F.col("from_account_id").alias("src"), F.lit("Account").alias("src_label"),
        F.col("to_account_id").alias("dst"), F.lit("Account").alias("dst_label"), F.lit("PAYS").alias("rel_type"),
    ).distinct()
    scored = {r["account_id"]: r for r in score_accounts(project(nodes, edges), accounts, "node").collect()}
    assert len({scored[a]["community_id"] for a in RING}) <= 2
    assert scored["R0"]["risk_score"] == pytest.approx(1.0, abs=0.2) and scored["R0"]["similarity_score"] > 0
    assert scored["N5"]["risk_score"] == pytest.approx(0.15) and scored["N5"]["similarity_score"] is None
