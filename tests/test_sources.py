import datetime
import json

import pytest

from custgraph.model import EDGES, ENRICHMENT_LOG, NODES
from custgraph.sources import files, graph, log, nodes


def _write(folder, name, text):
    (folder / name).write_text(text)


@pytest.fixture
def csv_folder(tmp_path):
    for spec in NODES.values():
        header = ",".join(raw for raw, _, _ in spec.columns())
        _write(tmp_path, spec.file, header + "\n")
    _write(
        tmp_path, "customers.csv",
        ",".join(raw for raw, _, _ in NODES["customer"].columns()) + "\n"
        "C1,Ann,Lee,,,,Rome,,00012,2020-01-02,1980-05-06,,Employed,50000,700\n"
        'C2,Bob,Ray,,,,,,,2021-01-02,1981-05-06,"",,60000,650\n',
    )
    _write(
        tmp_path, "portfolio_holdings.csv",
        "holding_id,account_id,stock_id,shares,purchase_price,purchase_date,current_value,percentage_of_portfolio\n"
        "H1,A1,S1,5,1.5,2020-02-03,7.5,100.0\n",
    )
    return tmp_path


def test_typed_scan_keeps_text_and_nulls_blanks(spark, csv_folder):
    spec = NODES["customer"]
    rows = nodes.typed_nodes(nodes.read_csv(spark, str(csv_folder), spec), spec).orderBy("customer_id").collect()
    assert rows[0]["zip_code"] == "00012" and rows[0]["registration_date"] == datetime.date(2020, 1, 2)
    assert [r["risk_profile"] for r in rows] == [None, None]
    assert rows[1]["annual_income"] == 60000


def test_position_key_is_renamed(spark, csv_folder):
    spec = NODES["position"]
    df = nodes.typed_nodes(nodes.read_csv(spark, str(csv_folder), spec), spec)
    assert df.columns[0] == "position_id" and df.first()["position_id"] == "H1"


def test_bad_value_fails_or_is_set_aside(spark):
    spec = NODES["position"]
    raw = spark.createDataFrame(
        [("H1", "A1", "S1", "abc", "1", "2020-01-01", "1", "1"), ("H2", "A1", "S1", "3", "1", "2020-01-01", "1", "")],
        [raw for raw, _, _ in spec.columns()],
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        nodes.typed_nodes(raw, spec).collect()
    good, bad = nodes.split_rejects(raw, spec)
    assert [r["position_id"] for r in good.collect()] == ["H2"]
    assert [r["bad_columns"] for r in bad.collect()] == [["shares"]]


def test_edges_rename_both_account_columns():
    assert (EDGES["performs"].source_key, EDGES["performs"].source_column) == ("account_id", "from_account_id")
    assert (EDGES["benefits_to"].target_key, EDGES["benefits_to"].target_column) == ("account_id", "to_account_id")


def test_registry_endpoints_exist():
    labels = {s.label: s for s in NODES.values()}
    assert len(NODES) == 7 and len(EDGES) == 7
    for spec in EDGES.values():
        assert labels[spec.source_label].key == spec.source_key
        assert labels[spec.target_label].key == spec.target_key
        columns = [name for _, name, _ in NODES[spec.from_table].columns()]
        assert spec.source_column in columns and spec.target_column in columns


def test_load_all_counts_tables(spark, csv_folder):
    spark.sql("DROP DATABASE IF EXISTS cg_load CASCADE")
    assert nodes.missing_tables(spark, "cg_load") == set(NODES)
    counts = {(r["kind"], r["table_name"]): r["row_count"] for r in nodes.load_all(spark, str(csv_folder), "cg_load").collect()}
    assert counts["node", "customer"] == 2 and counts["relationship", "has_position"] == 1
    assert counts["node", "total"] == 3 and counts["relationship", "total"] == 2
    assert nodes.missing_tables(spark, "cg_load") == set()
    described = nodes.describe_tables(spark, ["cg_load.customer", "cg_load.nothing"]).collect()
    assert sum(r["table_name"] == "cg_load.customer" for r in described) == 15
    assert [r for r in described if r["table_name"] == "cg_load.nothing"][0]["error"]
    spark.sql("DROP DATABASE cg_load CASCADE")


def test_internal_columns_are_dropped(spark):
    df = spark.createDataFrame([(1, "x", "a")], ["<id>", "<labels>", "name"])
    assert graph.drop_internal(df).columns == ["name"]


def test_extract_selected_skips_base(spark, tmp_path):
    node_rows = spark.createDataFrame([("Customer:1", "Customer"), ("Sector:Tech", "Sector")], ["id", "label"])
    edges = spark.createDataFrame([("a", "b", "HAS_ACCOUNT"), ("a", "c", "INTERESTED_IN")], ["src", "dst", "rel_type"])
    report = graph.extract_selected(node_rows, edges, ["Customer"], ["HAS_ACCOUNT"], str(tmp_path / "out"))
    assert {(r["kind"], r["name"], r["rows"]) for r in report.collect()} == {
        ("nodes", "Sector", 1), ("relationships", "INTERESTED_IN", 1)
    }


def test_embeddings_file(spark, tmp_path):
    chunk = {
        "chunk_id": "k1", "index": 0, "text": "t", "document_id": "d1", "embedding": [0.5, 1],
        "metadata": {"document_title": "T", "document_type": "x", "section_header": "h"},
    }
    doc = {"document_id": "d1", "title": "T", "char_count": 1, "entity_references": {"customers": ["Ann"]}}
    _write(tmp_path, "e.json", json.dumps({"metadata": {"chunk_count": 1}, "documents": [doc], "chunks": [chunk]}, indent=1))
    df = files.read_embeddings(spark, str(tmp_path / "e.json"))
    row = files.chunk_rows(df).first()
    assert (row["chunk_id"], row["document_title"], row["embedding"]) == ("k1", "T", [0.5, 1.0])
    assert files.document_rows(df).first()["entity_references"]["customers"] == ["Ann"]


def test_html_and_proposal_files(spark, tmp_path):
    (tmp_path / "html").mkdir()
    _write(tmp_path / "html", "a.html", "<h1>x</h1>\n<p>y</p>")
    assert files.read_html(spark, str(tmp_path / "html")).first()["filename"] == "a.html"
    node = {"label": "Customer", "key_property": "customer_id", "key_value": "C1"}
    proposal = {
        "source_node": node, "target_node": node, "relationship_type": "R", "properties": {"a": 1}, "confidence": "high",
        "source_document": "d", "extracted_phrase": "e", "rationale": "r",
    }
    _write(tmp_path, "p.json", json.dumps({"auto_approve": [proposal], "flagged": [], "review": [proposal]}))
    rows = files.read_proposal_files(spark, str(tmp_path / "p.json")).collect()
    assert sorted(r["bucket"] for r in rows) == ["auto_approve", "review"]
    assert rows[0]["properties"] == {"a": "1"}


def test_lines_are_written_in_order(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], ["n", "line"])
    files.write_lines(df, str(tmp_path / "out"), "n")
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert "".join(p.read_text() for p in parts).split() == ["a", "b", "c"]


def _proposals(spark, rows):
    return spark.createDataFrame(
        rows,
        "relationship_type string, source_label string, source_key_property string, source_key_value string,"
        "target_label string, target_key_property string, target_key_value string, properties map<string,string>,"
        "confidence string, source_document string, extracted_phrase string, rationale string",
    )


ONE = ("R", "Customer", "customer_id", "C1", "Sector", "name", "Tech", {"n": "1"}, "high", "d", "it's a\\b", "r")


def test_log_append_is_safe_to_repeat(spark):
    spark.sql("DROP TABLE IF EXISTS cg_log")
    log.ensure_log(spark, "cg_log")
    log.ensure_log(spark, "cg_log")
    assert [f.name for f in spark.table("cg_log").schema] == ENRICHMENT_LOG.fieldNames()
    assert log.append_log(_proposals(spark, []), "cg_log", "run0") == 0
    assert log.append_log(_proposals(spark, [ONE]), "cg_log", "run1") == 1
    assert log.append_log(_proposals(spark, [ONE]), "cg_log", "run1") == 0
    row = spark.table("cg_log").collect()
    assert len(row) == 1 and row[0]["extracted_phrase"] == "it's a\\b" and row[0]["properties_json"] == '{"n":"1"}'
    spark.sql("DROP TABLE cg_log")


def test_snapshot_pointer_moves(spark, tmp_path):
    root = str(tmp_path / "customers")
    log.write_snapshot(spark.createDataFrame([(1,)], "a int"), root)
    first = log.read_snapshot(spark, root)
    log.write_snapshot(first.selectExpr("a + 1 as a"), root)
    assert [r["a"] for r in log.read_snapshot(spark, root).collect()] == [2]
    assert [r["a"] for r in first.collect()] == [1]
