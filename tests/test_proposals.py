import datetime
import json

import pytest
from pyspark.sql import functions as F

from custgraph.model import UNIQUE_KEYS
from custgraph.operators import context, proposals, reports, upsert
from custgraph.plans.enrichment_cycle import enrichment_cycle
from custgraph.sources.log import log_rows

SCHEMA = (
    "relationship_type string, source_label string, source_key_property string, source_key_value string,"
    "target_label string, target_key_property string, target_key_value string, properties map<string,string>,"
    "confidence string, source_document string, extracted_phrase string, rationale string, proposed_at timestamp"
)


def one(source="C0001", target="Technology", confidence="high", rel="INTERESTED_IN", doc="d1", at=1, props=None):
    when = datetime.datetime(2024, 1, at)
    return (rel, "Customer", "customer_id", source, "Sector", "name", target, props or {}, confidence, doc, "phrase", "why", when)


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_log_key_removes_known_proposals(spark):
    log = log_rows(frame(spark, one(target="RenewableEnergy")), "run0")
    batch = frame(spark, one(target="RenewableEnergy", confidence="low"), one())
    assert [r["target_key_value"] for r in proposals.deduplicate(batch, log).collect()] == ["Technology"]
    empty = log.limit(0)
    assert proposals.deduplicate(batch, empty).count() == 2


def test_repeats_in_a_batch_keep_the_most_confident(spark):
    batch = frame(spark, one(confidence="medium", doc="m"), one(confidence="high", doc="h"), one(confidence="low", doc="l"))
    kept = proposals.deduplicate(batch, log_rows(batch.limit(0), "r")).collect()
    assert [r["source_document"] for r in kept] == ["h"]


def test_buckets(spark):
    batch = frame(spark, *[one(confidence=c) for c in ("high", "medium", "low", "high")])
    assert {r["bucket"]: r["proposals"] for r in proposals.bucket_counts(batch).collect()} == {
        "auto_approve": 2, "flagged": 1, "review": 1
    }


def test_validation_names_the_bad_fields(spark):
    batch = frame(spark, one(), one(confidence="sure"), one(source=" "))
    good, bad = proposals.validate_proposals(batch)
    assert good.count() == 1
    assert sorted(r["bad_fields"] for r in bad.collect()) == [["confidence"], ["source_key_value"]]


def test_text_that_is_no_json_is_rejected(spark):
    df = spark.createDataFrame([("not json",), (json.dumps({"relationship_type": "R"}),)], ["j"])
    good, bad = proposals.validate_proposals(proposals.parse_proposals(df, "j"))
    assert good.isEmpty() and bad.count() == 2


def test_prior_lines(spark):
    log = log_rows(frame(spark, one(), one(source="C0002")), "run0")
    lines = [r["line"] for r in proposals.prior_enrichment_lines(log).orderBy(*context.LINE_ORDER).collect()]
    assert lines == [
        "### INTERESTED_IN (2 relationships)",
        "- (Customer C0001) -[INTERESTED_IN]-> (Sector Technology) [high]",
        "- (Customer C0002) -[INTERESTED_IN]-> (Sector Technology) [high]",
    ]
    assert proposals.prior_enrichment_lines(log.limit(0)).isEmpty()


def world(spark):
    nodes = spark.createDataFrame([("Customer:C0001", "Customer", "C0001")], "id string, label string, key string")
    edges = spark.createDataFrame([], "src string, dst string, rel_type string")
    return nodes, edges


def test_unknown_source_writes_nothing_and_missing_target_is_made(spark):
    nodes, edges = world(spark)
    batch = frame(spark, one(at=1, confidence="medium", props={"a": "1"}), one(at=2, doc="d2", props={"b": "2"}), one(source="C9"))
    at = F.lit("2024-03-01").cast("timestamp")
    new_nodes, new_edges, written = upsert.enrichment_upsert(batch, nodes, edges, "run1", at)
    assert {r["id"] for r in new_nodes.collect()} == {"Customer:C0001", "Sector:Technology"}
    (edge,) = new_edges.collect()
    assert (edge["source_document"], edge["run_id"], edge["properties"]) == ("d2", "run1", {"b": "2"})
    assert all(edge[c] is not None for c in ("confidence", "extracted_phrase", "enrichment_timestamp"))
    assert written.count() == 2
    plan = {(r["src"], r["target_action"], r["edge_action"]) for r in upsert.writeback_plan(batch, nodes, edges).collect()}
    assert plan == {("Customer:C0001", "insert_node", "insert_edge"), ("Customer:C9", "none", "skip")}


def test_second_cycle_changes_nothing(spark):
    nodes, edges = world(spark)
    batch = frame(spark, one(), one(), one(target="Energy", confidence="medium"), one(source="C9"))
    log = log_rows(batch.limit(0), "none")
    first = enrichment_cycle(batch, nodes, edges, log, "run1")
    assert (first.counts["fresh"], first.counts["written"], first.counts["flagged"]) == (2, 1, 1)
    second = enrichment_cycle(batch, first.nodes, first.edges, first.log, "run2")
    assert second.counts["written"] == 0
    for name in ("nodes", "edges", "log"):
        assert getattr(second, name).count() == getattr(first, name).count()
    assert second.added.isEmpty() and first.added.count() == 1
    stamps = {r["enrichment_timestamp"] for r in first.log.collect()} | {r["enrichment_timestamp"] for r in first.edges.collect()}
    assert len(stamps) == 1


def test_node_upsert_is_idempotent_and_nulls_overwrite(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, name string, kept string")
    new = spark.createDataFrame([(2, None, 5), (3, "c", 6)], "id int, name string, extra int")
    after = upsert.upsert_nodes(old, new, "id")
    assert {tuple(r) for r in after.collect()} == {
        (1, "a", "x", None, "keep"), (2, None, "y", 5, "update"), (3, "c", None, 6, "insert")
    }
    again = upsert.upsert_nodes(after.drop("action"), new, "id").drop("action")
    assert sorted(again.collect(), key=str) == sorted(after.drop("action").collect(), key=str)
    assert upsert.update_columns(old, new, "id").count() == 2


def test_edges_need_both_ends(spark):
    nodes = spark.createDataFrame([("a",), ("b",)], ["id"])
    new = spark.createDataFrame([("a", "b", "R"), ("a", "b", "R"), ("a", "z", "R"), ("z", "a", "R")], ["src", "dst", "rel_type"])
    assert [tuple(r) for r in upsert.upsert_edges(new.limit(0), new, nodes).collect()] == [("a", "b", "R", "insert")]


def test_newest_per_key_with_many_copies(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), "id")
    assert upsert.newest_per_key(df, ["k"], [F.col("id")]).first()["id"] == 999


def test_suggestions_skip_failed_analyses(spark):
    good = {"new_entities": {"suggested_nodes": [{"label": "GOAL", "confidence": "high"}, {"label": "X"}]}}
    df = spark.createDataFrame([("r1", json.dumps(good)), ("r2", "broken")], ["run", "j"])
    parsed = proposals.parse_analyses(df, "j")
    stats = proposals.suggestion_stats(proposals.consolidate_suggestions(parsed, "j", "run"), "run").collect()
    assert [(r["run"], r["total_suggestions"], r["high_confidence_count"]) for r in stats] == [("r1", 2, 1)]
    assert {r["run"]: r["success"] for r in proposals.analysis_success(parsed, "j", "run").collect()} == {"r1": True, "r2": False}


def test_missing_fields(spark):
    got = context.missing_fields(spark, ["customer_id", "employer"])
    assert got.count() == 5 and "employer" not in {r["field"] for r in got.collect()}


def test_prior_report_is_a_whole_text(spark):
    log = log_rows(frame(spark, one(source="C0002"), one()), "run0")
    text = [r["line"] for r in reports.prior_report(log).orderBy("position").collect()]
    assert text == [
        reports.PRIOR_TITLE, "", "### INTERESTED_IN (2 relationships)",
        "- (Customer C0001) -[INTERESTED_IN]-> (Sector Technology) [high]",
        "- (Customer C0002) -[INTERESTED_IN]-> (Sector Technology) [high]", "", reports.PRIOR_ADVICE, "",
    ]
    assert reports.prior_report(log.limit(0)).isEmpty()
    totals = {r["relationship_type"]: r["rows"] for r in reports.enrichment_totals(log).collect()}
    assert totals == {"INTERESTED_IN": 2, None: 2}


def test_positions_follow_the_order_with_nulls_last(spark):
    rows = spark.createDataFrame([("b", "1", None), ("a", "2", 5.0), ("c", "3", 9.0), ("d", "4", 5.0)], "account_id string, customer_id string, risk_score double")
    got = {r["account_id"]: r["position"] for r in reports.in_order(rows, "combined_risk").collect()}
    assert got == {"c": 1, "a": 2, "d": 3, "b": 4}


def test_all_key_rules_are_asked(spark):
    tables = {label: spark.createDataFrame([("a",), ("b",)], [key]) for label, key in UNIQUE_KEYS.items()}
    assert upsert.all_key_violations(tables).isEmpty()
    tables["Bank"] = tables["Bank"].unionAll(tables["Bank"])
    assert {tuple(r) for r in upsert.all_key_violations(tables).collect()} == {("Bank", "a", 2), ("Bank", "b", 2)}
    with pytest.raises(ValueError, match="Chunk"):
        upsert.all_key_violations({k: v for k, v in tables.items() if k != "Chunk"})
