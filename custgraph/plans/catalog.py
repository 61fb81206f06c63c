"""Registered relational queries: each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..graph import fastrp as fastrp_module
from ..graph import knn as knn_module
from ..graph import louvain as louvain_module
from ..graph import pagerank as pagerank_module
from ..graph import projection, similarity
from ..functions.skew import copy_rows, hot_keys, slice_rows
from ..functions.text import preview, safe_float, slugify
from ..functions.vectors import explode_vector
from ..ml import features, metrics, registry, split, train
from ..model import DEDUP_KEY, EDGES, NODES, NodeSpec
from ..operators import context, documents, fraud, proposals, reports, retrieval, style, upsert
from ..sources import graph as graph_scan
from ..sources import log as log_table
from ..session import cut_lineage, keep, shared_dir
from ..sources import nodes as node_tables
from .portfolio import Portfolio

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
RUN_ID = "run-000000000001"
RUN_TIME = "2024-02-01 00:00:00"


def query(build: Callable[[Portfolio], DataFrame]) -> Callable[[Portfolio], DataFrame]:
    """Registers a query under its function name."""
    REGISTRY[build.__name__] = lambda spark, folder: build(Portfolio(spark, folder))
    return build


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def run_time():
    return F.lit(RUN_TIME).cast("timestamp")


# ----------------------------------------------------------------- sources

_ORDERS_SPEC = NodeSpec(
    "Account", "account_id", "account", "orders.csv",
    "o_orderkey>account_id string, o_custkey>customer_id string, o_totalprice>balance double,"
    "o_orderdate>opened_date date, o_orderstatus>status string",
)


@query
def load_typed_nodes(p: Portfolio) -> DataFrame:
    raw = p.raw("orders")
    as_text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return node_tables.typed_nodes(as_text, _ORDERS_SPEC)


@query
def derive_edges(p: Portfolio) -> DataFrame:
    accounts = p.account_at_bank()
    parts = []
    for name in ("has_account", "at_bank"):
        edges = node_tables.edge_table(accounts, EDGES[name])
        parts.append(
            edges.select(
                F.lit(name).alias("edge_table"),
                F.col(f"`{edges.columns[0]}`").alias("source_key"),
                F.col(f"`{edges.columns[1]}`").alias("target_key"),
            )
        )
    return parts[0].unionByName(parts[1])


@query
def derive_all_edges(p: Portfolio) -> DataFrame:
    """The seven edge tables of the portfolio, side by side."""
    tables = p.tables() | {"account": p.account_at_bank(), "transaction": p.payment()}
    parts = [
        edges.toDF("source_key", "target_key").select(F.lit(name).alias("edge_table"), "source_key", "target_key")
        for name, edges in node_tables.edge_tables(tables).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def table_row_counts(p: Portfolio) -> DataFrame:
    tables = p.tables()
    edges = node_tables.edge_tables(tables)
    return node_tables.row_counts(tables, "node").unionByName(node_tables.row_counts(edges, "relationship"))


@query
def explode_document_json(p: Portfolio) -> DataFrame:
    """The conversations written as embeddings-file records, parsed and exploded again."""
    from ..model import EMBEDDINGS_FILE
    from ..sources.files import chunk_rows

    chunk = F.struct(
        F.col("chunk_id"), F.col("index").cast("int").alias("index"), "text",
        F.col("document_id").cast("string").alias("document_id"),
        F.struct(F.concat(F.lit("Conversation "), F.col("document_id").cast("string")).alias("document_title"),
                 F.lit("conversation").alias("document_type")).alias("metadata"),
    )
    text = F.to_json(F.struct(F.array(chunk).alias("chunks")))
    parsed = p.conversation_chunks().select(F.from_json(text, EMBEDDINGS_FILE).alias("f")).select("f.*")
    return chunk_rows(parsed).select(
        "chunk_id", "index", "document_id", "document_title", "document_type", F.length("text").alias("chars")
    )


@query
def scan_nodes_by_label(p: Portfolio) -> DataFrame:
    tables = p.tables()
    return node_tables.unified_nodes({t: tables[t] for t in ("customer", "account", "stock")})


@query
def scan_edges_flattened(p: Portfolio) -> DataFrame:
    accounts = p.account()
    flat = graph_scan.scan_edges(
        node_tables.edge_table(accounts, EDGES["has_account"]),
        p.customer().select("customer_id", "last_name", "risk_profile"), "customer_id",
        accounts.select("account_id", "account_type", "balance"), "account_id",
    )
    return flat.toDF(*[c.replace(".", "_") for c in flat.columns])


@query
def discover_graph_schema(p: Portfolio) -> DataFrame:
    return graph_scan.discover_schema(node_tables.unified_edges(p.tables()))


@query
def selective_extract(p: Portfolio) -> DataFrame:
    found = graph_scan.beyond_base(p.proposals(), "relationship_type", ("CLICK", "VIEW"))
    return found.groupBy("relationship_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("source_key_value").alias("sources")
    )


@query
def unique_key_violations(p: Portfolio) -> DataFrame:
    line = p.raw("lineitem").select("l_orderkey", "l_linenumber")
    order = p.raw("orders").select("o_orderkey")
    return upsert.unique_key_violations(line, "LineItem", ["l_orderkey", "l_linenumber"], p.rows("lineitem")).unionByName(
        upsert.unique_key_violations(order, "Account", ["o_orderkey"], p.rows("orders"))
    )


@query
def all_key_violations(p: Portfolio) -> DataFrame:
    """Nine key rules; the chunks are keyed by their conversation alone, which repeats."""
    tables = p.tables()
    chunks = p.conversation_chunks().select(F.col("document_id").alias("chunk_id"))
    read = {"Customer": "customer", "Account": "orders", "Stock": "part", "Position": "lineitem", "Transaction": "lineitem",
            "Document": "documents"}
    return upsert.all_key_violations({
        **{NODES[name].label: frame for name, frame in tables.items()}, "Transaction": p.payment(),
        "Document": p.document(), "Chunk": chunks.withColumn("chunk_id", F.col("chunk_id").cast("string")),
    }, {label: p.rows(table) for label, table in read.items()})


@query
def log_append_rows(p: Portfolio) -> DataFrame:
    rows = log_table.log_rows(p.batch(), RUN_ID, run_time())
    return rows.withColumn("enrichment_timestamp", F.date_format("enrichment_timestamp", "yyyy-MM-dd HH:mm:ss"))


# ----------------------------------------------------------------- context


@query
def customer_profiles(p: Portfolio) -> DataFrame:
    return context.customer_profiles(p.customer()).select(
        "customer_id", "first_name", "last_name", "state", "annual_income", "credit_score", "risk_profile"
    )


@query
def customer_accounts(p: Portfolio) -> DataFrame:
    return context.customer_accounts(p.account()).drop("interest_rate")


_HOLDING_COLUMNS = (
    "customer_id", "last_name", "account_id", "account_type", "position_id", "ticker", "company_name",
    "sector", "shares", "current_value",
)


@query
def portfolio_holdings(p: Portfolio) -> DataFrame:
    return rounded(context.portfolio_holdings(p.tables()).select(*_HOLDING_COLUMNS), 2, "current_value")


@query
def portfolio_holdings_nine_tables(p: Portfolio) -> DataFrame:
    tables = p.tables()
    joined = context.portfolio_holdings(tables, node_tables.edge_tables(tables))
    return rounded(joined.select(*_HOLDING_COLUMNS), 2, "current_value")


@query
def sector_exposure(p: Portfolio) -> DataFrame:
    df = context.sector_exposure(p.sector_lots())
    return rounded(df, 4, "sector_value", "total_value", "sector_pct")


@query
def account_summary(p: Portfolio) -> DataFrame:
    return rounded(context.account_summary(p.customer(), p.account()), 2, "total_balance")


@query
def data_completeness(p: Portfolio) -> DataFrame:
    return rounded(context.data_completeness(p.customer()), 4, "pct")


@query
def sample_customers(p: Portfolio) -> DataFrame:
    return context.sample_customers(p.customer())


@query
def label_split_counts(p: Portfolio) -> DataFrame:
    return context.label_counts(p.customer())


@query
def portfolio_context(p: Portfolio) -> DataFrame:
    return context.portfolio_lines(context.portfolio_holdings(p.tables()))


@query
def profile_context(p: Portfolio) -> DataFrame:
    return context.profile_lines(p.customer(), p.account())


@query
def completeness_context(p: Portfolio) -> DataFrame:
    return context.completeness_lines(p.customer())


@query
def safe_float_values(p: Portfolio) -> DataFrame:
    return p.raw("events").select(
        "event_id",
        safe_float(F.get_json_object("props", "$.k")).alias("k"),
        safe_float("event_type").alias("bad"),
        safe_float("props").alias("json"),
    )


@query
def slugify_names(p: Portfolio) -> DataFrame:
    return p.raw("part").select("p_partkey", slugify(F.concat_ws(" / ", "p_name", "p_brand")).alias("slug"))


@query
def preview_text(p: Portfolio) -> DataFrame:
    return p.raw("documents").select(
        "doc_id", preview("text", 120).alias("short"), preview("text", 300).alias("long")
    )


# ----------------------------------------------------------------- fraud


@query
def suspicious_communities(p: Portfolio) -> DataFrame:
    df = fraud.suspicious_communities(p.fraud_account(), p.bank(), min_accounts=12)
    return rounded(df, 6, "risk_score", "similarity_score")


@query
def structuring_accounts(p: Portfolio) -> DataFrame:
    return rounded(fraud.structuring_accounts(p.fraud_account(), p.transaction()), 6, "risk_score")


@query
def flow_edges(p: Portfolio) -> DataFrame:
    return fraud.flow_edges(fraud.community_transfers(p.fraud_account(), p.transaction()))


@query
def flow_rings(p: Portfolio) -> DataFrame:
    return fraud.flow_rings(fraud.community_transfers(p.fraud_account(), p.transaction()))


@query
def coordinated_positions(p: Portfolio) -> DataFrame:
    df = fraud.coordinated_positions(p.fraud_account(), p.fraud_position(), p.stock(), p.company())
    return rounded(df, 6, "market_cap_billions")


def _report(p: Portfolio) -> dict[str, DataFrame]:
    from .fraud_report import fraud_sections

    return fraud_sections(
        p.customer(), p.fraud_account(), p.bank(), p.transaction(), p.fraud_position(), p.stock(), p.company(),
        min_accounts=12,
    )


@query
def risk_signals(p: Portfolio) -> DataFrame:
    return _report(p)["risk_signals"]


@query
def combined_risk(p: Portfolio) -> DataFrame:
    return rounded(_report(p)["combined_risk"], 6, "risk_score", "similarity_score")


@query
def fraud_summary(p: Portfolio) -> DataFrame:
    return _report(p)["summary"]


@query
def property_coverage(p: Portfolio) -> DataFrame:
    return rounded(fraud.property_coverage(p.fraud_account()), 6, "avg_risk_score")


# ----------------------------------------------------------------- proposals and upserts


@query
def proposal_dedup(p: Portfolio) -> DataFrame:
    return proposals.deduplicate(p.batch(), p.log()).select(*DEDUP_KEY, "confidence", "source_document")


@query
def confidence_buckets(p: Portfolio) -> DataFrame:
    return proposals.bucket_counts(p.proposals())


@query
def prior_enrichments(p: Portfolio) -> DataFrame:
    return proposals.prior_enrichment_lines(p.log())


@query
def prior_report(p: Portfolio) -> DataFrame:
    """The lines of the log as one text, in order."""
    return reports.prior_report(p.log())


@query
def enrichment_totals(p: Portfolio) -> DataFrame:
    return reports.enrichment_totals(p.log())


@query
def enrichment_types(p: Portfolio) -> DataFrame:
    return proposals.enrichment_types(p.log())


@query
def ingest_proposals(p: Portfolio) -> DataFrame:
    """Events as proposal JSON text, parsed and checked; bad ones keep the names of the bad fields."""
    flat = p.proposals()
    text = F.to_json(
        F.struct(
            F.struct(
                F.col("source_label").alias("label"), F.col("source_key_property").alias("key_property"),
                F.col("source_key_value").alias("key_value"),
            ).alias("source_node"),
            F.struct(
                F.col("target_label").alias("label"), F.col("target_key_property").alias("key_property"),
                F.col("target_key_value").alias("key_value"),
            ).alias("target_node"),
            F.when(F.col("relationship_type") != "ERROR", F.col("relationship_type")).alias("relationship_type"),
            F.when(F.col("confidence") == "low", "unsure").otherwise(F.col("confidence")).alias("confidence"),
            "properties", "source_document", "extracted_phrase", "rationale",
        )
    )
    parsed = proposals.parse_proposals(flat.select(text.alias("json")), "json")
    good, bad = proposals.validate_proposals(parsed)
    columns = ["source_document", "relationship_type", "source_key_value", "target_key_value", "confidence"]
    return good.select(*columns, F.lit("").alias("bad")).unionByName(
        bad.select(*columns, F.array_join("bad_fields", ",").alias("bad"))
    )


def _analysis_json(p: Portfolio) -> DataFrame:
    """Parts as analysis results: a run per brand, suggestions named by type and size."""
    suggestion = lambda kind, name: F.struct(
        F.col("p_type").alias(name), F.col("p_name").alias("description"),
        F.when(F.col("p_size") >= 40, "high").when(F.col("p_size") >= 10, "medium").alias("confidence"),
        F.col("p_name").alias("source_evidence"), F.lit(kind).alias("rationale"),
    )
    text = F.to_json(
        F.struct(
            F.when(F.col("p_size") % 2 == 0, F.struct(F.array(suggestion("n", "label")).alias("suggested_nodes"))).alias("new_entities"),
            F.when(F.col("p_size") % 3 == 0, F.struct(F.array(suggestion("a", "property_name")).alias("suggested_attributes"))).alias("missing_attributes"),
            F.when(F.col("p_size") % 5 != 0, F.struct(F.array(suggestion("r", "relationship_type")).alias("suggested_relationships"))).alias("implied_relationships"),
        )
    )
    raw = p.raw("part").select(F.col("p_brand").alias("run"), text.alias("result"))
    return proposals.parse_analyses(raw, "result")


@query
def consolidate_suggestions(p: Portfolio) -> DataFrame:
    found = proposals.consolidate_suggestions(_analysis_json(p), "result", "run")
    return found.groupBy("run", "kind", "name", "confidence").agg(F.count(F.lit(1)).alias("suggestions"))


@query
def suggestion_stats(p: Portfolio) -> DataFrame:
    analyses = _analysis_json(p)
    stats = proposals.suggestion_stats(proposals.consolidate_suggestions(analyses, "result", "run"), "run")
    return stats.join(proposals.analysis_success(analyses, "result", "run"), "run")


@query
def upsert_nodes(p: Portfolio) -> DataFrame:
    """Suppliers update the customers with the same number and add none; orders' owners
    with no customer row would be inserted."""
    existing = p.raw("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    incoming = p.raw("part").select(
        F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("balance"), F.col("p_brand").alias("brand")
    )
    return upsert.upsert_nodes(existing, incoming, "id")


@query
def upsert_edges(p: Portfolio) -> DataFrame:
    """Holdings added to the ownership edges; holdings of parts the graph lacks are dropped."""
    edges = p.graph_edges()
    nodes = p.graph_nodes()
    existing = edges.filter(F.col("rel_type") == "HAS_ACCOUNT")
    suppliers = p.raw("lineitem").select(
        p.tag("C", "l_suppkey").alias("src"), p.tag("P", "l_linenumber").alias("dst"), F.lit("SUPPLIES").alias("rel_type")
    )
    return upsert.upsert_edges(existing, suppliers, nodes)


def _graph_state(p: Portfolio) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges before the batch: all customers, and what the log wrote."""
    log = p.log().filter(F.col("confidence") != "low")
    customers = p.raw("customer").select(
        F.concat(F.lit("Customer:C"), F.col("c_custkey")).alias("id"), F.lit("Customer").alias("label"),
        p.tag("C", "c_custkey").alias("key"),
    )
    items = log.select(
        F.concat_ws(":", "target_label", "target_key_value").alias("id"),
        F.col("target_label").alias("label"), F.col("target_key_value").alias("key"),
    ).distinct()
    edges = upsert.flat_edges(log, "run-0", F.lit("2024-01-21").cast("timestamp"))
    return customers.unionByName(items), edges.drop("target_label", "target_key_value")


@query
def writeback_plan(p: Portfolio) -> DataFrame:
    nodes, edges = _graph_state(p)
    return upsert.writeback_plan(p.batch(), nodes, edges)


@query
def enrichment_upsert(p: Portfolio) -> DataFrame:
    nodes, edges = _graph_state(p)
    high = p.batch().filter(F.col("confidence") != "low")
    _, after, _ = upsert.enrichment_upsert(high, nodes, edges, RUN_ID, run_time())
    return after.select(
        "src", "dst", "rel_type", "confidence", "source_document", "run_id",
        F.try_element_at("properties", F.lit("value")).try_cast("double").alias("value"),
    )


@query
def prediction_writeback(p: Portfolio) -> DataFrame:
    predictions = p.raw("customer").filter(F.col("c_acctbal") < 0).select(
        p.tag("C", "c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("predicted_risk_category")
    )
    after = upsert.write_predictions(p.customer(), predictions, "champion", run_time())
    return after.select(
        "customer_id", "risk_profile", "risk_category_predicted", "prediction_source",
        F.date_format("prediction_timestamp", "yyyy-MM-dd HH:mm:ss").alias("predicted_at"),
    )


# ----------------------------------------------------------------- style

_TEST_SCORES = {
    "growth": {"PROMO": 5.0, "ECONOMY": 4.0, "LARGE": 2.5},
    "income": {"STANDARD": 5.0, "SMALL": 4.5, "MEDIUM": 2.5},
    "balanced": {"MEDIUM": 4.0, "LARGE": 3.0, "ECONOMY": 2.5},
}


@query
def investment_style(p: Portfolio) -> DataFrame:
    return style.investment_style(p.customer(), p.sector_lots(), _TEST_SCORES)


@query
def top_sectors(p: Portfolio) -> DataFrame:
    return style.top_sectors(p.sector_lots())


@query
def sector_companies(p: Portfolio) -> DataFrame:
    return style.sector_companies(p.company())


@query
def representative_customers(p: Portfolio) -> DataFrame:
    return style.representative_customers(p.customer(), 25)


@query
def representative_banks(p: Portfolio) -> DataFrame:
    return style.shuffled_first(p.bank(), "bank_id", 6)


@query
def representative_companies(p: Portfolio) -> DataFrame:
    return style.representative_companies(p.company(), 12)


# ----------------------------------------------------------------- documents


@query
def describes_edges(p: Portfolio) -> DataFrame:
    return documents.describes_edges(p.document(), p.customer())


@query
def chunk_document_edges(p: Portfolio) -> DataFrame:
    chunks = p.conversation_chunks().select("chunk_id", "document_id")
    return documents.chunk_document_edges(chunks, p.document())


@query
def next_chunk_edges(p: Portfolio) -> DataFrame:
    return documents.next_chunk_edges(p.conversation_chunks())


@query
def document_entity_refs(p: Portfolio) -> DataFrame:
    held = p.fraud_position().withColumnRenamed("account_id", "customer_id")
    named = held.join(p.stock(), "stock_id").join(
        p.company().withColumnRenamed("name", "company_name"), "company_id"
    )
    return documents.document_entity_refs(named)


@query
def document_stats(p: Portfolio) -> DataFrame:
    return documents.document_stats(p.conversation_chunks())


@query
def html_sections(p: Portfolio) -> DataFrame:
    return documents.html_sections(p.raw("pages"), "page_id")


@query
def chunk_fixed(p: Portfolio) -> DataFrame:
    return documents.chunk_fixed(p.raw("documents").select("doc_id", "text"), "doc_id")


@query
def chunk_recursive(p: Portfolio) -> DataFrame:
    pieces = documents.chunk_recursive(p.raw("documents").select("doc_id", "text"), ["doc_id"])
    return pieces.select("doc_id", "piece", F.length("text").alias("chars"), F.md5("text").alias("digest"))


@query
def chunk_records(p: Portfolio) -> DataFrame:
    pieces = documents.chunk_fixed(
        p.document().select("document_id", "text"), "document_id", size=1000, overlap=100
    )
    about = documents.chunk_records(pieces, p.document())
    return about.select(
        "chunk_id", "document_id", "index", "document_title", "document_type", F.length("text").alias("chars")
    )


@query
def chunk_postings(p: Portfolio) -> DataFrame:
    return documents.chunk_postings(p.conversation_chunks())


@query
def text_topk(p: Portfolio) -> DataFrame:
    return rounded(documents.text_topk(p.conversation_chunks(), ["the", "que", "thion", "der"], 20), 6, "score")


# ----------------------------------------------------------------- retrieval


@query
def vector_topk(p: Portfolio) -> DataFrame:
    hits = retrieval.vector_topk(p.vector_chunks(), p.label_centroids())
    return rounded(hits, 6, "score")


def _hits(p: Portfolio) -> DataFrame:
    hits = retrieval.vector_topk(p.vector_chunks(), p.label_centroids())
    describes = documents.describes_edges(p.document(), p.customer())
    return retrieval.graph_aware_hits(hits, p.vector_chunks(), p.document(), describes, p.customer())


@query
def graph_aware_retrieval(p: Portfolio) -> DataFrame:
    return rounded(_hits(p), 6, "score").drop("text")


@query
def retrieval_context(p: Portfolio) -> DataFrame:
    return retrieval.excerpt_lines(_hits(p))


@query
def hash_embeddings(p: Portfolio) -> DataFrame:
    chunks = p.conversation_chunks()
    model = retrieval.fit_hash_embedder(chunks)
    embedded = retrieval.hash_embeddings(chunks, model)
    return embedded.select(
        "chunk_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x * x), 6).alias("squared_length"),
        F.size(F.filter("embedding", lambda x: x != 0)).alias("used_dimensions"),
    )


def _structured(p: Portfolio) -> DataFrame:
    return context.structured_lines(p.customer(), p.account(), context.portfolio_holdings(p.tables()))


@query
def analysis_contexts(p: Portfolio) -> DataFrame:
    """The five contexts over holdings, profiles, vectors and the log; a label centroid stands
    for the query vector of each analysis."""
    queries = dict(zip(retrieval.ANALYSIS_SECTIONS, p.label_centroids().values()))
    hits = retrieval.vector_topk(p.vector_chunks(), queries)
    describes = documents.describes_edges(p.document(), p.customer())
    found = retrieval.graph_aware_hits(hits, p.vector_chunks(), p.document(), describes, p.customer())
    return retrieval.analysis_contexts(
        _structured(p), retrieval.excerpt_lines(found), proposals.prior_enrichment_lines(p.log())
    )


@query
def analysis_excerpts(p: Portfolio) -> DataFrame:
    """Conversation turns found for the words of the five analysis names by the built-in embedder."""
    chunks = p.conversation_chunks()
    model = retrieval.fit_hash_embedder(chunks)
    texts = {name: name.replace("_", " ") for name in retrieval.ANALYSIS_SECTIONS}
    hits = retrieval.vector_topk(retrieval.hash_embeddings(chunks, model), retrieval.embed_queries(p.spark, model, texts))
    describes = documents.describes_edges(p.document(), p.customer())
    found = retrieval.graph_aware_hits(hits, chunks, p.document(), describes, p.customer())
    return retrieval.excerpt_lines(found)


# ----------------------------------------------------------------- vectors


@query
def explode_embedding(p: Portfolio) -> DataFrame:
    wide = explode_vector(p.raw("embeddings").select("vec_id", "embedding"), "embedding", 64, "fastrp_")
    return rounded(wide, 6, *[c for c in wide.columns if c != "vec_id"])


@query
def embedding_from_json(p: Portfolio) -> DataFrame:
    text = p.vector_chunks().select(F.col("chunk_id").alias("vec_id"), F.to_json("embedding").alias("embedding"))
    wide = explode_vector(text, "embedding", 64, "fastrp_")
    return rounded(wide, 5, *[c for c in wide.columns if c != "vec_id"])





# ----------------------------------------------------------------- graph


@query
def graph_projection_counts(p: Portfolio) -> DataFrame:
    graph = projection.project(p.graph_nodes(), p.graph_edges(), ["Customer", "Account", "Stock"], ["HAS_ACCOUNT", "HAS_POSITION"])
    return projection.projection_counts(graph)


@query
def projection_with_enrichment(p: Portfolio) -> DataFrame:
    """Base types plus every type of the log, over customers, accounts, stocks and items."""
    proposed = p.proposals().select(
        F.col("source_key_value").alias("src"), F.lit("Customer").alias("src_label"),
        F.col("target_key_value").alias("dst"), F.lit("Item").alias("dst_label"),
        F.col("relationship_type").alias("rel_type"),
    ).distinct()
    items = proposed.select(F.col("dst").alias("id"), F.lit("Item").alias("label")).distinct()
    log_types = proposals.enrichment_types(p.log().filter(F.col("confidence") == "high")).toDF("rel_type")
    base = p.graph_edges().select("rel_type").distinct()
    graph = projection.project(
        p.graph_nodes().unionByName(items), p.graph_edges().unionByName(proposed),
        ["Customer", "Account", "Stock", "Item"], base.unionByName(log_types),
    )
    return projection.projection_counts(graph)


def _graph(p: Portfolio) -> projection.Projection:
    return projection.project(p.graph_nodes(), p.graph_edges())


def _holding_graph(p: Portfolio) -> projection.Projection:
    return projection.project(p.holding_nodes(), p.holding_edges())


@query
def node_degree(p: Portfolio) -> DataFrame:
    return projection.node_degree(_graph(p))


@query
def property_writeback(p: Portfolio) -> DataFrame:
    """Degrees written to the customers and stocks of the graph, not to its accounts."""
    graph = _graph(p)
    values = projection.node_degree(graph).select("id", "degree")
    return upsert.write_properties(graph.nodes, values, ["Customer", "Stock"])


@query
def pagerank(p: Portfolio) -> DataFrame:
    return rounded(pagerank_module.pagerank(_graph(p)).scores, 6, "score")


@query
def fastrp(p: Portfolio) -> DataFrame:
    vectors = fastrp_module.fastrp(_holding_graph(p))
    return vectors.select("id", "label", F.posexplode("embedding").alias("dim", "value")).select(
        "id", "label", "dim", F.round("value", 6).alias("value")
    )


@query
def louvain(p: Portfolio) -> DataFrame:
    return louvain_module.louvain(_graph(p)).communities


@query
def modularity(p: Portfolio) -> DataFrame:
    """Modularity of the segments with every part in the community of its brand."""
    parts = p.raw("part").select(p.tag("P", "p_partkey").alias("id"), F.col("p_brand").alias("community_id"))
    both = p.communities().unionByName(parts)
    return rounded(louvain_module.modularity(keep(_holding_graph(p).directed), both), 9, "modularity")


@query
def graph_run_stats(p: Portfolio) -> DataFrame:
    """Node, relationship and community counts and the modularity of one feature run."""
    graph = _holding_graph(p)
    found = louvain_module.louvain(graph)
    counts = projection.projection_counts(graph).groupBy().agg(
        F.sum(F.when(F.col("kind") == "node", F.col("rows"))).alias("node_count"),
        F.sum(F.when(F.col("kind") == "relationship", F.col("rows"))).alias("relationship_count"),
    )
    return counts.withColumns(
        {"community_count": F.lit(found.community_count), "modularity": F.round(F.lit(found.modularity), 6)}
    )


PAIR_SLICE = 256  # suppliers of a nation that one slice pairs with all others


def _supplier_graph(p: Portfolio) -> projection.Projection:
    """Suppliers tied to all others of their nation: groups without a tie between them, so that the best communities are the nations."""
    one, two = (p.raw("supplier").select(p.tag("S", "s_suppkey").alias(x), F.col("s_nationkey").alias("nation")) for x in ("src", "dst"))
    # Pairs grow with the square of a nation: its rows are cut into slices, dealt to all tasks, that each meet the nation once.
    hot, width = hot_keys(one, "nation", PAIR_SLICE), int(p.spark.conf.get("spark.sql.shuffle.partitions"))
    left = slice_rows(one, "nation", hot, ["src"]).repartition(width, "nation", "salt")
    edges = left.join(copy_rows(two, "nation", hot), ["nation", "salt"]).filter(F.col("src") < F.col("dst")).select("src", "dst", F.lit("SAME_NATION").alias("rel_type"))
    return projection.Projection(one.select(F.col("src").alias("id"), F.lit("Supplier").alias("label")), edges)


@query
def louvain_groups(p: Portfolio) -> DataFrame:
    return louvain_module.louvain(_supplier_graph(p)).communities


@query
def louvain_group_stats(p: Portfolio) -> DataFrame:
    """Counts and modularity of the run whose best answer is known."""
    graph = _supplier_graph(p)
    found = louvain_module.louvain(graph)
    return graph.nodes.agg(F.count(F.lit(1)).alias("node_count")).crossJoin(
        graph.directed.agg(F.count(F.lit(1)).alias("relationship_count"))
    ).withColumns({"community_count": F.lit(found.community_count).cast("long"), "modularity": F.round(F.lit(found.modularity), 6)})


_CUTOFF = 0.05


def _similar(p: Portfolio) -> DataFrame:
    return keep(similarity.node_similarity(_holding_graph(p), cutoff=_CUTOFF))


@query
def node_similarity(p: Portfolio) -> DataFrame:
    return rounded(_similar(p), 6, "similarity")


@query
def similarity_distribution(p: Portfolio) -> DataFrame:
    return rounded(
        similarity.similarity_distribution(_similar(p)), 6, "min_similarity", "mean_similarity", "max_similarity"
    )


@query
def max_similarity(p: Portfolio) -> DataFrame:
    return rounded(similarity.max_similarity(_similar(p)), 6, "similarity_score")


@query
def community_overlap(p: Portfolio) -> DataFrame:
    return rounded(similarity.community_overlap(_similar(p), p.communities()), 6, "avg_similarity")


@query
def spotlight_neighbors(p: Portfolio) -> DataFrame:
    """The nearest neighbors of every unlabeled customer."""
    unlabeled = p.customer().filter(F.col("risk_profile").isNull()).select(F.col("customer_id").alias("id"))
    found = similarity.spotlight_neighbors(_similar(p), unlabeled, p.communities())
    return rounded(found, 6, "similarity")


@query
def knn(p: Portfolio) -> DataFrame:
    return rounded(knn_module.knn(p.raw("embeddings"), identifier="vec_id"), 6, "similarity")


@query
def knn_of_embeddings(p: Portfolio) -> DataFrame:
    """The nearest customers of each customer by their FastRP vectors."""
    vectors = fastrp_module.fastrp(_holding_graph(p), labels=["Customer"])
    vectors = vectors.select("id", F.transform("embedding", lambda x: F.round(x, 6)).alias("embedding"))
    return rounded(knn_module.knn(cut_lineage(vectors)), 6, "similarity")


def _knn_pairs(p: Portfolio) -> DataFrame:
    return keep(knn_of_embeddings(p))


@query
def knn_community_overlap(p: Portfolio) -> DataFrame:
    return rounded(similarity.community_overlap(_knn_pairs(p), p.communities()), 5, "avg_similarity")


@query
def knn_neighbors_by_name(p: Portfolio) -> DataFrame:
    names = [f"Customer {n:09d}" for n in (1, 2, 3)]
    return similarity.neighbors_by_name(_knn_pairs(p), p.customer(), p.communities(), names)


# ----------------------------------------------------------------- features, splits, models

MODELS = train.Settings()


def _vectors(p: Portfolio) -> DataFrame:
    """The vectors as embeddings of the customers with the same number."""
    return p.raw("embeddings").select(p.tag("C", "vec_id").alias("customer_id"), "embedding")


def _features(p: Portfolio, size: int = 64) -> DataFrame:
    return features.feature_table(p.customer(), _vectors(p), size)


def _labeled_vectors(p: Portfolio) -> DataFrame:
    """Vectors with their label as risk category."""
    return p.raw("embeddings").select(
        p.tag("C", "vec_id").alias("customer_id"), F.concat(F.lit("class "), F.col("label")).alias("risk_category")
    )


def _nearest_label(p: Portfolio) -> DataFrame:
    """(customer_id, predicted_risk_category): the label of the nearest other vector."""
    labels = _labeled_vectors(p)
    vectors = p.raw("embeddings").select(p.tag("C", "vec_id").alias("id"), "embedding")
    nearest = knn_module.knn(vectors, k=1)
    named = labels.select(F.col("customer_id").alias("target"), F.col("risk_category").alias("predicted_risk_category"))
    return nearest.join(named, "target").select(F.col("source").alias("customer_id"), "predicted_risk_category")


@query
def feature_table(p: Portfolio) -> DataFrame:
    nations = p.raw("customer").select(
        p.tag("C", "c_custkey").alias("customer_id"), F.col("c_nationkey").alias("community_id")
    )
    wide = features.feature_table(p.customer(), _vectors(p), 64, nations)
    return rounded(wide, 6, *[c for c in wide.columns if c.startswith("fastrp_")])


@query
def create_holdout(p: Portfolio) -> DataFrame:
    base = p.customer().select("customer_id", F.col("risk_profile").alias("risk_category"))
    hidden, truth = split.create_holdout(base, kept_per_class=20)
    return hidden.join(truth, "customer_id")


@query
def holdout_counts(p: Portfolio) -> DataFrame:
    base = p.customer().select("customer_id", F.col("risk_profile").alias("risk_category"))
    return split.holdout_counts(split.create_holdout(base, kept_per_class=20)[1])


@query
def reapply_holdout(p: Portfolio) -> DataFrame:
    base = p.customer().select("customer_id", F.col("risk_profile").alias("risk_category"))
    _, truth = split.create_holdout(base, kept_per_class=20, seed=7)
    return split.reapply_holdout(base, truth)


@query
def stratified_split(p: Portfolio) -> DataFrame:
    base = p.customer().select("customer_id", F.col("risk_profile").alias("risk_category"))
    return split.train_test_split(base, "risk_category", 0.3)


@query
def stratified_folds(p: Portfolio) -> DataFrame:
    base = p.customer().select("customer_id", F.col("risk_profile").alias("risk_category"))
    return split.assign_folds(split.labeled(base, "risk_category"), "risk_category", 5)


def _confusion(p: Portfolio) -> DataFrame:
    both = _labeled_vectors(p).join(_nearest_label(p), "customer_id")
    return metrics.confusion_counts(both, "risk_category", "predicted_risk_category")


@query
def confusion_matrix(p: Portfolio) -> DataFrame:
    return _confusion(p)


@query
def class_metrics(p: Portfolio) -> DataFrame:
    return rounded(metrics.class_metrics(_confusion(p)), 6, "precision", "recall", "f1")


@query
def macro_scores(p: Portfolio) -> DataFrame:
    return rounded(metrics.macro_scores(_confusion(p)), 6, "macro_f1", "accuracy")


@query
def evaluate_predictions(p: Portfolio) -> DataFrame:
    _, truth = split.create_holdout(_labeled_vectors(p))
    return rounded(metrics.evaluate_predictions(_nearest_label(p), truth), 6, "accuracy")


@query
def promotion_decision(p: Portfolio) -> DataFrame:
    """Brands as models: the mean size of promoted parts against that of the economy parts."""
    score = F.round(F.avg("p_size") / 50, 6).alias("val_f1_score")
    by_brand = lambda kind: p.raw("part").filter(F.col("p_type") == kind).groupBy(F.col("p_brand").alias("model_name"))
    candidates = by_brand("PROMO").agg(F.count(F.lit(1)).cast("int").alias("version"), score)
    return registry.promotion_decision(candidates, by_brand("ECONOMY").agg(score))


@query
def compare_experiments(p: Portfolio) -> DataFrame:
    """Brands as experiments, part types as classifiers, and nations without any run."""
    runs = p.raw("part").groupBy(F.col("p_brand").alias("experiment"), F.col("p_type").alias("classifier")).agg(
        F.round(F.avg("p_size") / 50, 6).alias("value")
    ).withColumns({"run": F.col("classifier"), "metric": F.lit("val_f1_score")})
    brands = p.raw("part").select(F.col("p_brand").alias("experiment")).distinct()
    nations = p.raw("nation").select(F.col("n_name").alias("experiment"))
    expected = brands.unionByName(nations).withColumn("label", F.concat(F.lit("run of "), "experiment"))
    return registry.compare_experiments(expected, runs)


@query
def pca_features(p: Portfolio) -> DataFrame:
    """Principal components of the scaled vectors of all customers: variance and share of each."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    table = _features(p)
    columns = features.feature_columns(table)
    model = Pipeline(stages=train.preprocessing(table, columns, 5)).fit(train.prepared(table, columns))
    parts = model.transform(train.prepared(table, columns)).select(F.posexplode(vector_to_array("pc")).alias("component", "value"))
    shares = F.create_map(*[F.lit(x) for i, v in enumerate(train.explained_variance(model)) for x in (i, v)])
    return parts.groupBy("component").agg(F.round(F.var_samp("value"), 4).alias("variance"), F.count(F.lit(1)).alias("rows")).withColumn(
        "explained", F.round(F.element_at(shares, F.col("component")), 6)
    )


@query
def train_trials(p: Portfolio) -> DataFrame:
    """Three classifiers on all labeled customers with five principal components."""
    table = keep(_features(p))
    return train.runs_table(table, "fastrp", train.train_trials(table, pca_components=5, settings=MODELS))


@query
def model_trials(p: Portfolio) -> DataFrame:
    """The trials with a test part set aside, per-class scores and the refit of the best."""
    table = keep(_features(p))
    found = train.train_trials(table, pca_components=3, test_size=0.3, settings=MODELS)
    return train.runs_table(table, "fastrp-test", found)


@query
def tabular_baseline(p: Portfolio) -> DataFrame:
    """The trials without the graph columns."""
    table = keep(_features(p))
    found = train.train_trials(table, exclude=features.graph_columns(table), settings=MODELS)
    return train.runs_table(table, "tabular", found)


def _forest(p: Portfolio) -> tuple[DataFrame, list[str], object]:
    """A forest on all labeled customers."""
    table = keep(_features(p))
    columns = features.feature_columns(table)
    known = split.labeled(train.prepared(table, columns), "risk_category")
    return table, columns, train.fit_one(known, columns, "RandomForest", None, MODELS)


@query
def feature_importance(p: Portfolio) -> DataFrame:
    table, columns, model = _forest(p)
    return train.feature_importance(train.prepared(table, columns), model)


@query
def score_unlabeled(p: Portfolio) -> DataFrame:
    table, columns, model = _forest(p)
    return registry.score_unlabeled(table, model, columns)


def _nation_features(p: Portfolio) -> DataFrame:
    """Customers with balance and a number for their nation, regions side by side; the region's name is the label, but for every fifth."""
    nations = p.raw("nation").join(p.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_regionkey", "r_name")
    number = F.col("c_custkey") % 5
    return p.raw("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        p.tag("C", "c_custkey").alias("customer_id"), F.col("c_acctbal").cast("double").alias("annual_income"),
        (100.0 * F.col("n_regionkey") + F.col("c_nationkey")).alias("credit_score"), F.when(number != 0, F.col("r_name")).alias("risk_category"),
        F.col("r_name").alias("true_risk_category"), (number == 0).alias("is_held_out"),
    )


@query
def champion_chain(p: Portfolio) -> DataFrame:
    """Two models are trained, scored on a test part, registered and promoted if better; the stored champion scores
    the customers without a label. The nation decides the region, so the first model, which knows it, is right, and the
    second, which knows the balance, is not promoted."""
    root = f"{shared_dir(p.spark)}/custgraph-{uuid.uuid4().hex}"
    table = keep(_nation_features(p))
    known = keep(split.train_test_split(split.labeled(table, "risk_category"), "risk_category", 0.3))
    promoted = []
    for columns in (["credit_score"], ["annual_income"]):
        model = train.fit_one(known.filter(~F.col("is_test")), columns, "RandomForest", None, MODELS)
        scored = model.transform(known.filter("is_test"))
        f1 = metrics.macro_scores(metrics.confusion_counts(scored, "risk_category", "predicted_risk_category")).first()["macro_f1"]
        promoted.append(registry.register(p.spark, root, "region", model, "RandomForest", f1))
    winner = registry.champion(registry.read_versions(p.spark, root), "region").first()
    predictions = registry.score_unlabeled(table, registry.load_champion(p.spark, root, "region"), ["credit_score"])
    result = metrics.evaluate_predictions(predictions, table).select("total", "correct", "accuracy")
    return predictions.crossJoin(F.broadcast(result)).select(
        "customer_id", "predicted_risk_category", F.lit(winner["version"]).cast("int").alias("version"),
        F.round(F.lit(winner["val_f1_score"]), 6).alias("val_f1_score"), F.lit(promoted[0]).alias("first_promoted"),
        F.lit(promoted[1]).alias("second_promoted"), "total", "correct", "accuracy",
    )


@query
def enrichment_cycle(p: Portfolio) -> DataFrame:
    """The batch applied twice: the second cycle finds everything in the log and writes nothing."""
    from .enrichment_cycle import enrichment_cycle as run_cycle

    nodes, edges = (keep(df) for df in _graph_state(p))
    log = keep(log_table.log_rows(p.log(), "run-0", run_time()))
    first = run_cycle(p.batch(), nodes, edges, log, RUN_ID, run_time())
    second = run_cycle(p.batch(), first.nodes, first.edges, first.log, "run-2", run_time())
    rows = []
    for number, cycle in enumerate((first, second), 1):
        sizes = {
            "nodes": cycle.nodes.count(), "edges": cycle.edges.count(),
            "log_keys": cycle.log.select(*DEDUP_KEY).distinct().count(),
        }
        rows += [(number, step, n) for step, n in (cycle.counts | sizes).items()]
    return p.spark.createDataFrame(rows, "cycle int, step string, rows bigint")


# ----------------------------------------------------------------- reports in order


@query
def ordered_customer_profiles(p: Portfolio) -> DataFrame:
    """All twelve columns of the profiles, by customer."""
    return reports.in_order(context.customer_profiles(p.customer()), "customer_profiles")


def _in_order(name: str) -> Query:
    return lambda spark, folder: reports.in_order(REGISTRY[name](spark, folder), name)


REGISTRY |= {f"ordered_{name}": _in_order(name) for name in reports.REPORT_ORDER if f"ordered_{name}" not in REGISTRY}
