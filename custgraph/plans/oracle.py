"""The registered queries as plain SQL over the same tables, written independently."""

from __future__ import annotations

from .catalog import _TEST_SCORES, RUN_ID, RUN_TIME
from .portfolio import LOG_UNTIL

# ------------------------------------------------------------------ shared views

CUSTOMER = """
customer_v AS (SELECT 'C' || c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
  split_part(c_name, '#', 2) AS last_name, CAST(c_nationkey AS VARCHAR) AS state,
  CAST(floor(c_acctbal) AS INTEGER) AS annual_income,
  CAST(floor(300 + (c_acctbal + 1000) / 20) AS INTEGER) AS credit_score,
  CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS risk_profile FROM customer)"""

POSITION = """
position_v AS (SELECT 'H' || l_orderkey || '-' || l_partkey AS position_id, l_orderkey, l_partkey,
  CAST(sum(l_quantity) AS INTEGER) AS shares, sum(l_extendedprice) AS current_value,
  max(l_discount) * 100 AS pct FROM lineitem GROUP BY l_orderkey, l_partkey)"""

HOLDINGS = f"""{CUSTOMER}, {POSITION},
holding_v AS (SELECT c.customer_id, c.first_name, c.last_name, 'A' || o_orderkey AS account_id,
  o_orderpriority AS account_type, position_id, p_name AS ticker, p_brand AS company_name, p_type AS sector,
  shares, current_value, pct
  FROM position_v JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer_v c ON c.customer_id = 'C' || o_custkey)"""

LOTS = """
lot_v AS (SELECT 'C' || o_custkey AS customer_id, p_type AS sector, l_extendedprice AS current_value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

FRAUD = """
acc AS (SELECT 'C' || c_custkey AS account_id, 'B' || c_nationkey AS bank_id, c_mktsegment AS community_id,
  c_acctbal / 1000 AS risk_score, CASE WHEN c_acctbal >= 0 THEN c_acctbal / 10000 END AS similarity_score
  FROM customer),
txn AS (SELECT 'C' || o_custkey AS from_account, 'C' || l_suppkey AS to_account, l_extendedprice AS amount,
  CAST(l_shipdate AS DATE) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
band AS (SELECT * FROM txn WHERE amount >= 8000 AND amount < 10000),
comm AS (SELECT community_id, bank_id, count(*) AS account_count FROM acc GROUP BY 1, 2 HAVING count(*) >= 12),
struct_v AS (SELECT from_account AS account_id, count(*) AS structuring_count, round(avg(amount), 2) AS avg_amount,
  round(sum(amount), 2) AS total_amount, min(d) AS first_date, max(d) AS last_date
  FROM band GROUP BY 1 HAVING count(*) >= 3),
flow AS (SELECT s.community_id, from_account, to_account, count(*) AS txn_count, round(sum(amount), 2) AS total_amount
  FROM band JOIN acc s ON s.account_id = from_account JOIN acc r ON r.account_id = to_account
  WHERE s.community_id = r.community_id GROUP BY 1, 2, 3),
member AS (SELECT community_id, from_account AS account_id FROM flow INTERSECT
  SELECT community_id, to_account FROM flow),
ring AS (SELECT m.community_id, account_id, ring_size FROM member m JOIN
  (SELECT community_id, count(*) AS ring_size FROM member GROUP BY 1 HAVING count(*) >= 3) s
  ON m.community_id = s.community_id),
held AS (SELECT DISTINCT 'C' || o_custkey AS account_id, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
coord AS (SELECT community_id, 'S' || p_partkey AS stock_id, p_name AS ticker, p_brand AS company_name,
  p_retailprice / 1000 AS market_cap_billions, account_id, holder_count FROM (
    SELECT community_id, l_partkey, h.account_id, count(*) OVER (PARTITION BY community_id, l_partkey) AS holder_count
    FROM held h JOIN acc a ON a.account_id = h.account_id) JOIN part ON l_partkey = p_partkey WHERE holder_count >= 3),
flagged AS (SELECT account_id FROM struct_v UNION SELECT account_id FROM ring),
signals AS (
  SELECT account_id, 1 AS signal_order,
    'structuring: ' || structuring_count || ' txns, avg $' || format('{:,.2f}', avg_amount) AS signal FROM struct_v
  UNION ALL SELECT account_id, 2, 'circular_flow: ' || ring_size || '-account ring' FROM ring
  UNION ALL SELECT account_id, 3, 'coordinated_position: ' || ticker || ' ($' ||
    format('{:,.2f}', market_cap_billions) || 'B mcap)' FROM coord WHERE account_id IN (SELECT account_id FROM flagged)),
combined AS (SELECT s.account_id, s.account_id AS customer_id, count(*) AS signal_count,
  max(CASE WHEN signal_order = 1 THEN signal END) AS structuring,
  max(CASE WHEN signal_order = 2 THEN signal END) AS circular_flow,
  count(*) FILTER (WHERE signal_order = 3) AS position_signals FROM signals s GROUP BY 1)"""

PROPOSAL = f"""
prop AS (SELECT event_id, upper(event_type) AS relationship_type, 'Customer' AS source_label,
  'C' || user_id AS source_key_value, 'Item' AS target_label, 'I' || json_extract_string(props, '$.k') AS target_key_value,
  CASE WHEN value >= 300 THEN 'high' WHEN value >= 100 THEN 'medium' ELSE 'low' END AS confidence,
  lpad(CAST(event_id AS VARCHAR), 20, '0') AS source_document, event_type, props, value, ts FROM events),
log_v AS (SELECT * FROM prop WHERE ts < TIMESTAMP '{LOG_UNTIL}'),
batch_v AS (SELECT * FROM prop WHERE ts >= TIMESTAMP '{LOG_UNTIL}')"""

_KEY = "relationship_type, source_label, source_key_value, target_label, target_key_value"

GRAPH = f"""{PROPOSAL},
old_edge AS (SELECT 'Customer:' || source_key_value AS src, 'Item:' || target_key_value AS dst,
  relationship_type AS rel_type, confidence, source_document, value FROM (
    SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY ts DESC, source_document DESC) AS rn
    FROM log_v WHERE confidence <> 'low') WHERE rn = 1),
node AS (SELECT 'Customer:C' || c_custkey AS id FROM customer UNION SELECT dst FROM old_edge)"""

DOCUMENT = """
doc_v AS (SELECT doc_id AS document_id, 'Customer Profile - Customer ' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS title,
  CASE WHEN lang = 'en' THEN 'customer_profile' ELSE 'market_analysis' END AS document_type, text FROM documents),
describe_v AS (SELECT document_id, 'C' || c_custkey AS customer_id, replace(c_name, '#', ' ') AS customer_name
  FROM doc_v JOIN customer ON 'Customer Profile - ' || replace(c_name, '#', ' ') = title
  WHERE document_type = 'customer_profile')"""

HITS = f"""{DOCUMENT},
el AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
cen AS (SELECT label AS q, i, avg(x) AS m FROM el GROUP BY 1, 2),
clen AS (SELECT q, sqrt(sum(m * m)) AS n FROM cen GROUP BY 1),
vlen AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM el GROUP BY 1),
sc AS (SELECT q, el.vec_id, sum(x * m) / (any_value(clen.n) * any_value(vlen.n)) AS score
  FROM el JOIN cen USING (i) JOIN clen USING (q) JOIN vlen USING (vec_id) GROUP BY 1, 2),
hit AS (SELECT CAST(q AS VARCHAR) AS query, CAST(rank AS INTEGER) AS rank, vec_id AS chunk_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 9) DESC, vec_id) AS rank FROM sc) WHERE rank <= 5),
ghit AS (SELECT query, rank, chunk_id, 'vector ' || chunk_id AS text, score, CAST(chunk_id AS VARCHAR) AS document_id,
  coalesce(title, 'Unknown') AS document_title, coalesce(document_type, 'unknown') AS document_type,
  customer_id, customer_name
  FROM hit LEFT JOIN doc_v ON doc_v.document_id = chunk_id LEFT JOIN describe_v ON describe_v.document_id = chunk_id)"""

CHUNK = """
chunk_v AS (SELECT conv_id || '-' || turn AS chunk_id, conv_id AS document_id, turn AS "index", text FROM conversations)"""

PREVIEW = "CASE WHEN length(text) > {n} THEN substr(text, 1, {n}) || '...' ELSE text END"


def _with(views: str, body: str) -> str:
    return f"WITH {views.strip()}{body}" if body.startswith(",") else f"WITH {views.strip()}\n{body}"


def _recursive(views: str, body: str) -> str:
    return f"WITH RECURSIVE {views.strip()}\n{body}"


_HOLDING_SELECT = """SELECT customer_id, last_name, account_id, account_type, position_id, ticker, company_name, sector,
  shares, round(current_value, 2) AS current_value FROM holding_v"""


def _money(x: str, digits: int = 2) -> str:
    return f"'$' || format('{{:,.{digits}f}}', {x})"


def _pct(x: str, digits: int = 1) -> str:
    return f"format('{{:,.{digits}f}}', {x}) || '%'"


SQL: dict[str, str] = {}

# ------------------------------------------------------------------ sources

SQL["load_typed_nodes"] = """SELECT CAST(o_orderkey AS VARCHAR) AS account_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  o_totalprice AS balance, CAST(o_orderdate AS DATE) AS opened_date, o_orderstatus AS status FROM orders"""

SQL["derive_edges"] = """SELECT 'has_account' AS edge_table, 'C' || o_custkey AS source_key, 'A' || o_orderkey AS target_key
  FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT 'at_bank', 'A' || o_orderkey, 'B' || c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey"""

_COUNTS = """
n AS (SELECT 'customer' AS t, count(*) AS c FROM customer UNION ALL SELECT 'account', count(*) FROM orders
  UNION ALL SELECT 'bank', count(*) FROM nation
  UNION ALL SELECT 'company', count(*) FROM (SELECT DISTINCT p_brand, p_type FROM part)
  UNION ALL SELECT 'stock', count(*) FROM part
  UNION ALL SELECT 'position', count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)),
r AS (SELECT 'has_account' AS t, c FROM n WHERE t = 'account' UNION ALL SELECT 'of_company', c FROM n WHERE t = 'stock'
  UNION ALL SELECT 'has_position', c FROM n WHERE t = 'position' UNION ALL SELECT 'of_security', c FROM n WHERE t = 'position')"""
SQL["table_row_counts"] = _with(_COUNTS, """SELECT 'node' AS kind, t AS table_name, c AS row_count FROM n
  UNION ALL SELECT 'node', 'total', CAST(sum(c) AS BIGINT) FROM n
  UNION ALL SELECT 'relationship', t, c FROM r
  UNION ALL SELECT 'relationship', 'total', CAST(sum(c) AS BIGINT) FROM r""")

SQL["explode_document_json"] = """SELECT conv_id || '-' || turn AS chunk_id, CAST(turn AS INTEGER) AS "index",
  CAST(conv_id AS VARCHAR) AS document_id, 'Conversation ' || conv_id AS document_title,
  'conversation' AS document_type, length(text) AS chars FROM conversations"""

SQL["scan_nodes_by_label"] = """SELECT 'Customer:C' || c_custkey AS id, 'Customer' AS label, 'C' || c_custkey AS key FROM customer
  UNION ALL SELECT 'Account:A' || o_orderkey, 'Account', 'A' || o_orderkey FROM orders
  UNION ALL SELECT 'Stock:S' || p_partkey, 'Stock', 'S' || p_partkey FROM part"""

SQL["scan_edges_flattened"] = _with(CUSTOMER, """SELECT c.customer_id AS source_customer_id, c.last_name AS source_last_name,
  c.risk_profile AS source_risk_profile, 'A' || o_orderkey AS target_account_id, o_orderpriority AS target_account_type,
  o_totalprice AS target_balance FROM orders JOIN customer_v c ON c.customer_id = 'C' || o_custkey""")

SQL["discover_graph_schema"] = """SELECT 'HAS_ACCOUNT' AS rel_type, 'Customer' AS src_label, 'Account' AS dst_label, count(*) AS edges FROM orders
  UNION ALL SELECT 'OF_COMPANY', 'Stock', 'Company', count(*) FROM part
  UNION ALL SELECT 'HAS_POSITION', 'Account', 'Position', count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
  UNION ALL SELECT 'OF_SECURITY', 'Position', 'Stock', count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)"""

SQL["selective_extract"] = """SELECT upper(event_type) AS relationship_type, count(*) AS rows,
  count(DISTINCT user_id) AS sources FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1"""

SQL["unique_key_violations"] = """SELECT 'LineItem' AS label, l_orderkey || '|' || l_linenumber AS key_value, count(*) AS copies
  FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
  UNION ALL SELECT 'Account', CAST(o_orderkey AS VARCHAR), count(*) FROM orders GROUP BY o_orderkey HAVING count(*) > 1"""

SQL["log_append_rows"] = _with(PROPOSAL, f"""SELECT '{RUN_ID}' AS run_id, '{RUN_TIME}' AS enrichment_timestamp, relationship_type,
  source_label, 'customer_id' AS source_key_property, source_key_value, target_label, 'item_id' AS target_key_property,
  target_key_value, confidence, source_document, event_type AS extracted_phrase, props AS rationale,
  '{{"value":"' || CAST(value AS VARCHAR) || '"}}' AS properties_json FROM batch_v""")

# ------------------------------------------------------------------ context

SQL["customer_profiles"] = _with(CUSTOMER, """SELECT customer_id, first_name, last_name, state, annual_income, credit_score,
  risk_profile FROM customer_v""")
SQL["customer_accounts"] = """SELECT 'C' || o_custkey AS customer_id, 'A' || o_orderkey AS account_id,
  o_orderpriority AS account_type, o_totalprice AS balance, o_orderstatus AS status FROM orders"""
SQL["portfolio_holdings"] = _with(HOLDINGS, _HOLDING_SELECT)
SQL["portfolio_holdings_nine_tables"] = SQL["portfolio_holdings"]
SQL["sector_exposure"] = _with(LOTS, """, s AS (SELECT customer_id, sector, sum(current_value) AS sv FROM lot_v GROUP BY 1, 2),
  t AS (SELECT customer_id, sum(sv) AS tv FROM s GROUP BY 1)
  SELECT customer_id, sector, round(sv, 4) AS sector_value, round(tv, 4) AS total_value,
  round(CASE WHEN tv <> 0 THEN sv / tv * 100 ELSE 0 END, 4) AS sector_pct FROM s JOIN t USING (customer_id)""")
SQL["account_summary"] = """SELECT 'C' || c_custkey AS customer_id, count(o_orderkey) AS account_count,
  round(coalesce(sum(o_totalprice), 0), 2) AS total_balance, min('A' || o_orderkey) AS first_account_id
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1"""
_FIELDS = {
    "customer_id": "count(*)", "first_name": "count(*)", "last_name": "count(*)", "email": "0", "phone": "0", "city": "0",
    "state": "count(*)", "registration_date": "0", "date_of_birth": "0", "risk_profile": "count(risk_profile)",
    "employment_status": "0", "annual_income": "count(*)", "credit_score": "count(*)",
}
_COMPLETE = " UNION ALL ".join(
    f"SELECT '{f}' AS field, CAST({c} AS BIGINT) AS populated, count(*) AS total_rows FROM customer_v" for f, c in _FIELDS.items()
)
SQL["data_completeness"] = _with(CUSTOMER, f"""SELECT total_rows, field, populated,
  round(populated / total_rows * 100, 4) AS pct FROM ({_COMPLETE})""")
SQL["sample_customers"] = _with(CUSTOMER, """SELECT customer_id, first_name, last_name, 'no' AS has_email, 'no' AS has_phone,
  annual_income, credit_score FROM customer_v ORDER BY customer_id LIMIT 5""")
SQL["label_split_counts"] = _with(CUSTOMER, """SELECT CASE WHEN risk_profile IS NULL THEN 'unlabeled' ELSE 'labeled' END AS label_state,
  count(*) AS customers FROM customer_v GROUP BY 1""")

SQL["portfolio_context"] = _with(HOLDINGS, f""", s AS (SELECT customer_id, sector, sum(current_value) AS sv FROM holding_v GROUP BY 1, 2),
  t AS (SELECT customer_id, min(first_name || ' ' || last_name) AS name, sum(current_value) AS tv FROM holding_v GROUP BY 1),
  l AS (SELECT customer_id AS group_key, 0 AS block, '' AS sub_key, '' AS item_key,
    '## ' || name || ' (' || customer_id || ')' AS line FROM t
  UNION ALL SELECT customer_id, 1, '', '', 'Total portfolio value: ' || {_money('tv')} FROM t
  UNION ALL SELECT customer_id, 2, sector, '', '  ' || sector || ' (' || {_pct('sv / tv * 100')} || ' of portfolio):'
    FROM s JOIN t USING (customer_id)
  UNION ALL SELECT customer_id, 2, sector, position_id, '    ' || ticker || ' (' || company_name || '): ' || shares ||
    ' shares, ' || {_money('current_value')} || ' value, ' || {_pct('pct')} || ' of portfolio' FROM holding_v)
  SELECT '1_holdings' AS section, * FROM l""")

SQL["profile_context"] = _with(CUSTOMER, f""", a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
  l AS (SELECT customer_id AS group_key, 0 AS block, '' AS sub_key, '' AS item_key,
    '## ' || first_name || ' ' || last_name || ' (' || customer_id || ')' AS line FROM customer_v
  UNION ALL SELECT customer_id, 1, '', '', '  ' || concat_ws(' | ', 'Location: , ' || state,
    'Annual income: ' || {_money('annual_income::DOUBLE', 0)}, 'Credit score: ' || credit_score, 'Risk profile: ' || risk_profile) FROM customer_v
  UNION ALL SELECT 'C' || o_custkey, 2, '', '', '  Accounts (' || n || '):' FROM a
  UNION ALL SELECT 'C' || o_custkey, 3, '', 'A' || o_orderkey, '    A' || o_orderkey || ' (' || o_orderpriority || '): ' ||
    {_money('o_totalprice')} || ', status=' || o_orderstatus FROM orders)
  SELECT '2_profiles' AS section, * FROM l""")

_MISSING = {
    "occupation": "Job title and role", "employer": "Company or organization",
    "investment_philosophy": "Investment approach and strategy",
    "life_stage": "Career/life stage (mid-career, pre-retirement, etc.)",
    "financial_goals": "Stated financial objectives", "communication_preference": "Preferred contact method",
}
_MISSING_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in _MISSING.items())
SQL["completeness_context"] = _with(CUSTOMER, f""", f AS ({_COMPLETE}), l AS (
  SELECT 0 AS block, '' AS sub_key, 'Total customers: ' || count(*) AS line FROM customer_v
  UNION ALL SELECT 1, field, '  ' || field || ': ' || populated || '/' || total_rows || ' populated (' ||
    {_pct('populated / total_rows * 100', 0)} || ')' FROM f
  UNION ALL SELECT 2, k, '  ' || k || ': ' || v || ' — NOT IN SCHEMA' FROM (VALUES {_MISSING_ROWS}) AS m(k, v)
  UNION ALL SELECT 3, customer_id, '  ' || customer_id || ' ' || first_name || ' ' || last_name ||
    ': email=no, phone=no, income=' || annual_income || ', credit_score=' || credit_score
    FROM (SELECT * FROM customer_v ORDER BY customer_id LIMIT 5))
  SELECT '3_completeness' AS section, '' AS group_key, block, sub_key, '' AS item_key, line FROM l""")

SQL["safe_float_values"] = """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, 0.0::DOUBLE AS bad,
  0.0::DOUBLE AS json FROM events"""
SQL["slugify_names"] = """SELECT p_partkey, trim(regexp_replace(lower(p_name || ' / ' || p_brand), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part"""
SQL["preview_text"] = f"""SELECT doc_id, {PREVIEW.format(n=120)} AS short, {PREVIEW.format(n=300)} AS long FROM documents"""

# ------------------------------------------------------------------ fraud

SQL["suspicious_communities"] = _with(FRAUD, """SELECT a.community_id, a.bank_id, a.account_id, round(risk_score, 6) AS risk_score,
  round(similarity_score, 6) AS similarity_score, account_count, n_name AS bank_name
  FROM acc a JOIN comm USING (community_id, bank_id) JOIN nation ON 'B' || n_nationkey = a.bank_id""")
SQL["structuring_accounts"] = _with(FRAUD, """SELECT s.*, round(risk_score, 6) AS risk_score, community_id
  FROM struct_v s JOIN acc USING (account_id)""")
SQL["flow_edges"] = _with(FRAUD, "SELECT * FROM flow")
SQL["flow_rings"] = _with(FRAUD, "SELECT * FROM ring")
SQL["coordinated_positions"] = _with(FRAUD, """SELECT community_id, stock_id, ticker, company_name,
  round(market_cap_billions, 6) AS market_cap_billions, account_id, holder_count FROM coord""")
SQL["risk_signals"] = _with(FRAUD, "SELECT * FROM signals")
SQL["combined_risk"] = _with(f"{FRAUD}, {CUSTOMER}", """SELECT b.*, first_name || ' ' || last_name AS customer_name, annual_income, credit_score,
  'customer' AS account_type, round(risk_score, 6) AS risk_score, community_id, round(similarity_score, 6) AS similarity_score
  FROM combined b JOIN acc USING (account_id) JOIN customer_v c ON c.customer_id = b.customer_id""")
SQL["fraud_summary"] = _with(FRAUD, """SELECT 'suspicious_communities' AS section, count(*) AS entries FROM comm
  UNION ALL SELECT 'structuring_accounts', count(*) FROM struct_v UNION ALL SELECT 'circular_flow_edges', count(*) FROM flow
  UNION ALL SELECT 'circular_flow_rings', count(DISTINCT community_id) FROM ring
  UNION ALL SELECT 'coordinated_positions', count(*) FROM (SELECT DISTINCT community_id, stock_id FROM coord)
  UNION ALL SELECT 'flagged_accounts', count(*) FROM combined
  UNION ALL SELECT 'flagged_customers', count(DISTINCT customer_id) FROM combined""")
SQL["property_coverage"] = _with(FRAUD, """SELECT count(*) AS total_accounts, count(risk_score) AS with_risk_score,
  count(community_id) AS with_community, count(similarity_score) AS with_similarity,
  round(avg(risk_score), 6) AS avg_risk_score, count(DISTINCT community_id) AS communities FROM acc""")

# ------------------------------------------------------------------ proposals and upserts

SQL["proposal_dedup"] = _with(PROPOSAL, f"""SELECT {_KEY}, confidence, source_document FROM (
  SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END DESC,
    source_document DESC) AS rn FROM batch_v) b WHERE rn = 1
  AND NOT EXISTS (SELECT 1 FROM log_v l WHERE l.relationship_type = b.relationship_type
    AND l.source_key_value = b.source_key_value AND l.target_key_value = b.target_key_value)""")
SQL["confidence_buckets"] = _with(PROPOSAL, """SELECT CASE confidence WHEN 'high' THEN 'auto_approve' WHEN 'medium' THEN 'flagged'
  ELSE 'review' END AS bucket, count(*) AS proposals FROM prop GROUP BY 1""")
SQL["prior_enrichments"] = _with(PROPOSAL, """SELECT '5_prior' AS section, relationship_type AS group_key, 0 AS block, '' AS sub_key, '' AS item_key,
  '### ' || relationship_type || ' (' || count(*) || ' relationships)' AS line FROM log_v GROUP BY relationship_type
  UNION ALL SELECT '5_prior', relationship_type, 1, source_key_value, target_key_value,
  '- (Customer ' || source_key_value || ') -[' || relationship_type || ']-> (Item ' || target_key_value || ') [' || confidence || ']' FROM log_v""")
SQL["enrichment_types"] = _with(PROPOSAL, "SELECT DISTINCT relationship_type FROM log_v")
SQL["ingest_proposals"] = _with(PROPOSAL, """SELECT source_document, nullif(relationship_type, 'ERROR') AS relationship_type,
  source_key_value, target_key_value, CASE confidence WHEN 'low' THEN 'unsure' ELSE confidence END AS confidence,
  concat_ws(',', CASE WHEN relationship_type = 'ERROR' THEN 'relationship_type' END,
    CASE WHEN confidence = 'low' THEN 'confidence' END) AS bad FROM prop""")

_SUGGEST = """
part_v AS (SELECT p_brand AS run, p_type AS name, p_size,
  CASE WHEN p_size >= 40 THEN 'high' ELSE 'medium' END AS confidence FROM part),
sug AS (SELECT run, 'node' AS kind, name, confidence FROM part_v WHERE p_size % 2 = 0
  UNION ALL SELECT run, 'attribute', name, confidence FROM part_v WHERE p_size % 3 = 0
  UNION ALL SELECT run, 'relationship', name, confidence FROM part_v WHERE p_size % 5 <> 0)"""
SQL["consolidate_suggestions"] = _with(_SUGGEST, "SELECT run, kind, name, confidence, count(*) AS suggestions FROM sug GROUP BY 1, 2, 3, 4")
SQL["suggestion_stats"] = _with(_SUGGEST, """SELECT run, count(*) AS total_suggestions,
  count(*) FILTER (WHERE confidence = 'high') AS high_confidence_count,
  count(*) FILTER (WHERE kind = 'node') AS node_suggestions, count(*) FILTER (WHERE kind = 'attribute') AS attribute_suggestions,
  count(*) FILTER (WHERE kind = 'relationship') AS relationship_suggestions, true AS success FROM sug GROUP BY 1""")

SQL["upsert_nodes"] = """SELECT coalesce(p_partkey, c_custkey) AS id,
  CASE WHEN p_partkey IS NULL THEN c_acctbal ELSE p_retailprice END AS balance, c_mktsegment AS segment, p_brand AS brand,
  CASE WHEN c_custkey IS NULL THEN 'insert' WHEN p_partkey IS NOT NULL THEN 'update' ELSE 'keep' END AS action
  FROM customer FULL OUTER JOIN part ON c_custkey = p_partkey"""
SQL["upsert_edges"] = """SELECT 'C' || o_custkey AS src, 'O' || o_orderkey AS dst, 'HAS_ACCOUNT' AS rel_type, 'keep' AS action FROM orders
  UNION ALL SELECT DISTINCT 'C' || l_suppkey, 'P' || l_linenumber, 'SUPPLIES', 'insert' FROM lineitem
  WHERE l_suppkey IN (SELECT c_custkey FROM customer) AND l_linenumber IN (SELECT p_partkey FROM part)"""
SQL["writeback_plan"] = _with(GRAPH, """, w AS (SELECT DISTINCT 'Customer:' || source_key_value AS src,
    'Item:' || target_key_value AS dst, relationship_type AS rel_type FROM batch_v)
  SELECT src, dst, rel_type,
  CASE WHEN src NOT IN (SELECT id FROM node) THEN 'none' WHEN dst IN (SELECT id FROM node) THEN 'match_node' ELSE 'insert_node' END AS target_action,
  CASE WHEN src NOT IN (SELECT id FROM node) THEN 'skip' WHEN (src, dst, rel_type) IN (SELECT (src, dst, rel_type) FROM old_edge)
    THEN 'update_edge' ELSE 'insert_edge' END AS edge_action FROM w""")
SQL["enrichment_upsert"] = _with(GRAPH, f""", new_edge AS (SELECT 'Customer:' || source_key_value AS src, 'Item:' || target_key_value AS dst,
  relationship_type AS rel_type, confidence, source_document, value FROM (
    SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY ts DESC, source_document DESC) AS rn
    FROM batch_v WHERE confidence <> 'low') WHERE rn = 1 AND 'Customer:' || source_key_value IN (SELECT id FROM node))
  SELECT src, dst, rel_type, confidence, source_document, '{RUN_ID}' AS run_id, value FROM new_edge
  UNION ALL SELECT src, dst, rel_type, confidence, source_document, 'run-0', value FROM old_edge o
  WHERE NOT EXISTS (SELECT 1 FROM new_edge n WHERE n.src = o.src AND n.dst = o.dst AND n.rel_type = o.rel_type)""")
SQL["prediction_writeback"] = f"""SELECT 'C' || c_custkey AS customer_id, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS risk_profile,
  CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS risk_category_predicted,
  CASE WHEN c_acctbal < 0 THEN 'champion' END AS prediction_source,
  CASE WHEN c_acctbal < 0 THEN '{RUN_TIME}' END AS predicted_at FROM customer"""

# ------------------------------------------------------------------ style


def _score(style: str) -> str:
    cases = " ".join(f"WHEN '{sector}' THEN {w}" for sector, w in _TEST_SCORES[style].items())
    return f"CAST(sum(CASE sector {cases} ELSE 1.0 END) AS DOUBLE) AS {style}_score"


SQL["investment_style"] = _with(f"{CUSTOMER}, {LOTS}", f""", s AS (SELECT customer_id, {', '.join(_score(x) for x in _TEST_SCORES)} FROM lot_v GROUP BY 1)
  SELECT c.customer_id, CASE WHEN s.customer_id IS NULL THEN
      CASE WHEN annual_income > 100000 AND credit_score < 700 THEN 'growth' WHEN credit_score > 740 THEN 'income' ELSE 'balanced' END
    WHEN growth_score >= income_score AND growth_score >= balanced_score THEN 'growth'
    WHEN income_score >= balanced_score THEN 'income' ELSE 'balanced' END AS style,
  coalesce(growth_score, 0) AS growth_score, coalesce(income_score, 0) AS income_score, coalesce(balanced_score, 0) AS balanced_score
  FROM customer_v c LEFT JOIN s ON s.customer_id = c.customer_id""")
SQL["top_sectors"] = _with(LOTS, """SELECT * FROM (SELECT customer_id, sector, positions,
  CAST(row_number() OVER (PARTITION BY customer_id ORDER BY positions DESC, sector) AS INTEGER) AS rank
  FROM (SELECT customer_id, sector, count(*) AS positions FROM lot_v GROUP BY 1, 2)) WHERE rank <= 3""")
SQL["sector_companies"] = """WITH co AS (SELECT DISTINCT p_brand || '-' || p_type AS company_id, p_brand, p_type FROM part),
  r AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY company_id) AS rn, count(*) OVER (PARTITION BY p_type) AS n FROM co)
  SELECT p_type AS sector, any_value(n) AS companies, string_agg(p_brand, ', ' ORDER BY rn) AS names,
  string_agg(p_brand, ', ' ORDER BY rn) AS tickers FROM r WHERE rn <= 8 GROUP BY 1"""
SQL["representative_customers"] = _with(CUSTOMER, """, lab AS (SELECT *, md5('42:' || customer_id) AS k FROM customer_v WHERE risk_profile IS NOT NULL),
  one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY risk_profile ORDER BY k, customer_id) AS rn FROM lab) WHERE rn = 1),
  rest AS (SELECT *, row_number() OVER (ORDER BY annual_income NULLS FIRST, customer_id) AS rk, count(*) OVER () AS n FROM lab
    WHERE customer_id NOT IN (SELECT customer_id FROM one)),
  need AS (SELECT 25 - count(*) AS m FROM one),
  str AS (SELECT customer_id, risk_profile, rk FROM rest, need WHERE (rk - 1) % greatest(1, n // m) = 0 AND rk <= greatest(1, n // m) * m),
  fill AS (SELECT customer_id, risk_profile, row_number() OVER (ORDER BY md5('42:' || customer_id), customer_id) AS rk
    FROM customer_v WHERE risk_profile IS NULL),
  al AS (SELECT customer_id, risk_profile, 'class' AS source, 1 AS place, 0 AS rk FROM one
    UNION ALL SELECT customer_id, risk_profile, 'income', 2, rk FROM str
    UNION ALL SELECT customer_id, risk_profile, 'unlabeled', 3, rk FROM fill)
  SELECT customer_id, risk_profile, source, place FROM al ORDER BY place, rk LIMIT 25""")
SQL["representative_companies"] = """WITH co AS (SELECT DISTINCT p_brand || '-' || p_type AS company_id, p_brand AS name, p_type AS sector FROM part),
  r AS (SELECT *, md5('42:' || company_id) AS k FROM co),
  q AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY sector ORDER BY k, company_id) = 1 THEN 1 ELSE 2 END AS place FROM r)
  SELECT company_id, name, sector, place FROM q ORDER BY place, k, company_id LIMIT 12"""

# ------------------------------------------------------------------ documents

SQL["describes_edges"] = _with(DOCUMENT, "SELECT document_id, customer_id FROM describe_v")
SQL["chunk_document_edges"] = _with(CHUNK, """SELECT document_id, chunk_id FROM chunk_v JOIN documents ON doc_id = document_id""")
SQL["next_chunk_edges"] = _with(CHUNK, """SELECT a.document_id, a.chunk_id AS from_chunk, b.chunk_id AS to_chunk
  FROM chunk_v a JOIN chunk_v b ON a.document_id = b.document_id AND b."index" = a."index" + 1""")
SQL["document_entity_refs"] = """WITH h AS (SELECT 'C' || o_custkey AS customer_id, p_brand, p_name FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
  SELECT customer_id, 'company' AS kind, p_brand AS reference, count(*) AS mentions FROM h GROUP BY 1, 2, 3
  UNION ALL SELECT customer_id, 'ticker', p_name, count(*) FROM h GROUP BY 1, 2, 3"""
SQL["document_stats"] = _with(CHUNK, """SELECT document_id, CAST(sum(length(text)) AS BIGINT) AS char_count, count(*) AS chunk_count
  FROM chunk_v GROUP BY 1""")

_CHUNKS = """
piece AS (SELECT {id}, i AS "index", i * ({size} - {overlap}) AS start,
  regexp_replace(substr(text, i * ({size} - {overlap}) + 1, {size}), '^\\s+|\\s+$', '', 'g') AS text
  FROM (SELECT {id}, text, unnest(range(0, 1 + greatest(CAST(ceil((length(text) - {overlap}) / ({size} - {overlap})) AS INTEGER) - 1, 0))) AS i
  FROM {table} WHERE text <> ''))"""
SQL["chunk_fixed"] = _with(_CHUNKS.format(id="doc_id", size=4000, overlap=200, table="documents"),
                           """SELECT doc_id, CAST("index" AS INTEGER) AS "index", CAST(start AS INTEGER) AS start, text FROM piece WHERE length(text) >= 50""")
# Runs of at most 3,800 characters, each with up to 200 characters of the run before it.
SQL["chunk_recursive"] = r"""
WITH RECURSIVE run AS (
  SELECT doc_id, -1 AS piece, '' AS part, '' AS before, text AS rest, length(text) <= 4000 AS whole FROM documents WHERE text <> ''
  UNION ALL
  SELECT doc_id, piece + 1, substr(rest, 1, cut), part, substr(rest, cut + 1), whole FROM (
    SELECT *, CASE WHEN whole OR length(rest) <= 3800 THEN length(rest)
      WHEN blank > 0 THEN blank WHEN line > 0 THEN line WHEN word > 0 THEN word ELSE 3800 END AS cut FROM (
      SELECT *, length(regexp_extract(substr(rest, 1, 3800), '(?s)^.*\n\n')) AS blank,
        length(regexp_extract(substr(rest, 1, 3800), '(?s)^.*\n')) AS line,
        length(regexp_extract(substr(rest, 1, 3800), '(?s)^.* ')) AS word FROM run WHERE rest <> ''))
), chunk AS (
  SELECT doc_id, piece, regexp_replace(regexp_replace(right(before, 200), '^[^ \n]*[ \n]', '') || part, '^\s+|\s+$', '', 'g') AS text
  FROM run WHERE piece >= 0)
SELECT doc_id, CAST(piece AS INTEGER) AS piece, CAST(length(text) AS INTEGER) AS chars, md5(text) AS digest FROM chunk WHERE length(text) >= 50"""
SQL["chunk_records"] = _with(
    DOCUMENT + "," + _CHUNKS.format(id="document_id", size=1000, overlap=100, table="doc_v"),
    """SELECT md5(p.document_id || ':' || "index") AS chunk_id, p.document_id, CAST("index" AS INTEGER) AS "index",
  title AS document_title, document_type, length(p.text) AS chars FROM piece p JOIN doc_v d ON d.document_id = p.document_id
  WHERE length(p.text) >= 50""")



def _html_text(x: str) -> str:
    """Readable text of an HTML fragment, as nested SQL calls."""
    block = "p|div|li|ul|ol|br|tr|table|section|article|header|footer|nav|h[1-6]"
    x = f"regexp_replace({x}, '(?i)</?({block})\\b[^>]*>', chr(10), 'g')"
    x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    x = f"regexp_replace({x}, '[ \\t\\r]+', ' ', 'g')"
    x = f"regexp_replace({x}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _html_sql() -> str:
    body = "regexp_replace(html, '(?is)^.*?<body[^>]*>', '')"
    body = f"regexp_replace({body}, '(?is)<(script|style)\\b.*?</(script|style)>', '', 'g')"
    views = [f"l0 AS (SELECT page_id, regexp_replace({body}, '(?s)<!--.*?-->', '', 'g') AS part FROM pages)"]
    names, keep = ("section_header", "section_subheader", "section_detail"), "page_id"
    for n, name in enumerate(names, 1):
        marked = f"regexp_replace(part, '(?i)<h{n}\\b', chr(1) || '<h{n}', 'g')"
        views.append(
            f"s{n} AS (SELECT {keep}, unnest(string_split({marked}, chr(1))) AS piece, "
            f"generate_subscripts(string_split({marked}, chr(1)), 1) - 1 AS p{n} FROM l{n - 1})"
        )
        head = f"regexp_matches(piece, '(?i)^<h{n}\\b')"
        title = _html_text(f"regexp_extract(piece, '(?is)^<h{n}\\b[^>]*>(.*?)</h{n}>', 1)")
        rest = f"regexp_replace(piece, '(?is)^<h{n}\\b[^>]*>.*?</h{n}>', '')"
        views.append(
            f"l{n} AS (SELECT {keep}, CAST(p{n} AS INTEGER) AS p{n}, CASE WHEN {head} THEN {title} ELSE '' END AS {name}, "
            f"CASE WHEN {head} THEN {rest} ELSE piece END AS part FROM s{n})"
        )
        keep += f", p{n}, {name}"
    return "WITH " + ",\n".join(views) + f"\nSELECT * FROM (SELECT {keep}, {_html_text('part')} AS text FROM l3) WHERE text <> ''"


SQL["html_sections"] = _html_sql()

_WORDS = "[^\\p{L}\\p{N}]+"
SQL["chunk_postings"] = _with(CHUNK, f"""SELECT token, chunk_id, count(*) AS tf FROM (
  SELECT chunk_id, unnest(regexp_split_to_array(lower(text), '{_WORDS}')) AS token FROM chunk_v) WHERE token <> '' GROUP BY 1, 2""")
SQL["text_topk"] = _with(CHUNK, f""", w AS (SELECT chunk_id, unnest(regexp_split_to_array(lower(text), '{_WORDS}')) AS token FROM chunk_v),
  t AS (SELECT * FROM w WHERE token <> ''),
  len AS (SELECT c.chunk_id, count(token) AS l FROM chunk_v c LEFT JOIN t ON t.chunk_id = c.chunk_id GROUP BY 1),
  tot AS (SELECT count(*) AS n, avg(l) AS mean FROM len),
  tf AS (SELECT chunk_id, token, count(*) AS f FROM t WHERE token IN ('the', 'que', 'thion', 'der') GROUP BY 1, 2),
  df AS (SELECT token, count(*) AS d FROM tf GROUP BY 1)
  SELECT chunk_id, round(sum(ln(1 + (n - d + 0.5) / (d + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score
  FROM tf JOIN df USING (token) JOIN len USING (chunk_id), tot GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")

# ------------------------------------------------------------------ retrieval

SQL["vector_topk"] = _with(HITS, "SELECT query, rank, chunk_id, round(score, 6) AS score FROM hit")
SQL["graph_aware_retrieval"] = _with(HITS, "SELECT * EXCLUDE (text, score), round(score, 6) AS score FROM ghit")
SQL["retrieval_context"] = _with(HITS, """SELECT query, rank, coalesce(customer_id, '') AS customer_key,
  '## [' || rank || '] ' || document_title || ' (' || document_type || ', relevance: ' || format('{:,.3f}', score) || ')' ||
  CASE WHEN customer_id IS NOT NULL THEN ' — Customer: ' || customer_name || ' (' || customer_id || ')' ELSE '' END ||
  chr(10) || chr(10) || text || chr(10) AS line FROM ghit""")

SQL["explode_embedding"] = "SELECT vec_id, " + ", ".join(
    f"round(embedding[{i + 1}]::DOUBLE, 6) AS fastrp_{i}" for i in range(64)
) + " FROM embeddings"
SQL["embedding_from_json"] = "SELECT vec_id, " + ", ".join(
    f"round(embedding[{i + 1}]::DOUBLE, 5) AS fastrp_{i}" for i in range(64)
) + " FROM embeddings"

# ------------------------------------------------------------------ graph

_OWNS = "SELECT 'C' || o_custkey AS src, 'O' || o_orderkey AS dst, 'HAS_ACCOUNT' AS rel_type FROM orders"
_HOLDS = "SELECT DISTINCT 'O' || l_orderkey AS src, 'P' || l_partkey AS dst, 'HAS_POSITION' AS rel_type FROM lineitem"
PORTFOLIO_GRAPH = f"""
one_way AS ({_OWNS} UNION ALL {_HOLDS}),
directed AS (SELECT src, dst, rel_type FROM one_way UNION ALL SELECT dst, src, rel_type FROM one_way),
gnode AS (SELECT 'C' || c_custkey AS id, 'Customer' AS label FROM customer UNION ALL
  SELECT 'O' || o_orderkey, 'Account' FROM orders UNION ALL SELECT 'P' || p_partkey, 'Stock' FROM part),
deg AS (SELECT src AS id, count(*) AS degree FROM directed GROUP BY 1)"""
HOLDING_GRAPH = """
one_way AS (SELECT DISTINCT 'C' || o_custkey AS src, 'P' || l_partkey AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
directed AS (SELECT src, dst FROM one_way UNION ALL SELECT dst, src FROM one_way),
gnode AS (SELECT 'C' || c_custkey AS id, 'Customer' AS label FROM customer UNION ALL SELECT 'P' || p_partkey, 'Stock' FROM part),
deg AS (SELECT src AS id, count(*) AS degree FROM directed GROUP BY 1)"""

_COUNT_BODY = """SELECT 'node' AS kind, label AS name, count(*) AS rows FROM gnode GROUP BY label
  UNION ALL SELECT 'relationship', rel_type, count(*) FROM directed GROUP BY rel_type"""
SQL["graph_projection_counts"] = _with(PORTFOLIO_GRAPH, _COUNT_BODY)
SQL["projection_with_enrichment"] = _with(f"{PROPOSAL}, {PORTFOLIO_GRAPH}", """,
  extra AS (SELECT DISTINCT source_key_value, target_key_value, relationship_type FROM prop),
  used AS (SELECT * FROM extra WHERE relationship_type IN (SELECT relationship_type FROM log_v WHERE confidence = 'high'))
  SELECT 'node' AS kind, label AS name, count(*) AS rows FROM gnode GROUP BY label
  UNION ALL SELECT 'node', 'Item', count(DISTINCT target_key_value) FROM extra HAVING count(*) > 0
  UNION ALL SELECT 'relationship', rel_type, count(*) FROM directed GROUP BY rel_type
  UNION ALL SELECT 'relationship', relationship_type, 2 * count(*) FROM used GROUP BY relationship_type""")
SQL["node_degree"] = _with(PORTFOLIO_GRAPH, "SELECT n.id, label, coalesce(degree, 0) AS degree FROM gnode n LEFT JOIN deg d ON d.id = n.id")


def _pagerank_sql(rounds: int = 20, damping: float = 0.85) -> str:
    views = [PORTFOLIO_GRAPH.strip(), f"r0 AS (SELECT id, {1 - damping}::DOUBLE AS score FROM gnode)"]
    for i in range(rounds):
        views.append(
            f"r{i + 1} AS MATERIALIZED (SELECT n.id, {1 - damping} + {damping} * coalesce(s, 0) AS score FROM gnode n LEFT JOIN "
            f"(SELECT dst, sum(score / degree) AS s FROM directed JOIN r{i} ON r{i}.id = src JOIN deg ON deg.id = src GROUP BY 1) "
            f"ON dst = n.id)"
        )
    return "WITH " + ",\n".join(views) + f"\nSELECT g.id, label, round(score, 6) AS score FROM r{rounds} JOIN gnode g USING (id)"


SQL["pagerank"] = _pagerank_sql()


def _fastrp_sql(size: int = 128, weights: tuple = (0.0, 1.0, 1.0, 0.8, 0.5), seed: int = 42) -> str:
    draw = f"('0x' || substr(md5('{seed}:' || id || ':' || k), 1, 8))::BIGINT % 6"
    views = [
        HOLDING_GRAPH.strip(),
        f"x0 AS (SELECT id, k, CASE {draw} WHEN 0 THEN sqrt(3) WHEN 1 THEN -sqrt(3) ELSE 0 END AS v "
        f"FROM gnode, range({size}) t(k))",
    ]
    for i in range(len(weights)):
        views.append(f"x{i + 1} AS MATERIALIZED (SELECT dst AS id, k, avg(v) AS v FROM directed JOIN x{i} ON id = src GROUP BY 1, 2)")
        views.append(f"n{i + 1} AS (SELECT id, sqrt(sum(v * v)) AS n FROM x{i + 1} GROUP BY 1)")
    parts = " UNION ALL ".join(
        f"SELECT x.id, k, CASE WHEN n > 0 THEN {w} * v / n ELSE 0 END AS e FROM x{i} x JOIN n{i} n ON n.id = x.id"
        for i, w in enumerate(weights, 1)
    )
    views.append(f"e AS (SELECT id, k, sum(e) AS value FROM ({parts}) GROUP BY 1, 2)")
    return "WITH " + ",\n".join(views) + (
        f"\nSELECT g.id, label, CAST(t.k AS INTEGER) AS dim, round(coalesce(value, 0), 6) AS value "
        f"FROM gnode g CROSS JOIN range({size}) t(k) LEFT JOIN e ON e.id = g.id AND e.k = t.k"
    )


SQL["fastrp"] = _fastrp_sql()


def _pca_sql(size: int = 64, components: int = 5, squarings: int = 24) -> str:
    """Eigenvalues of the correlation matrix, the largest first: the matrix squared again and again gives the
    direction of its largest one, which is then taken out."""
    def product(a: str, b: str) -> str:
        return f"list_transform({a}, lambda r: list_transform({b}, lambda c: list_dot_product(r, c)))"

    views = [
        f"cell AS (SELECT c_custkey AS id, k, coalesce(embedding[k]::DOUBLE, 0) AS v FROM customer CROSS JOIN range(1, {size + 1}) t(k) "
        "LEFT JOIN embeddings ON vec_id = c_custkey)",
        "entry AS (SELECT a.k AS i, b.k AS j, corr(a.v, b.v) AS v FROM cell a JOIN cell b ON a.id = b.id GROUP BY 1, 2)",
        "line AS (SELECT i, list(v ORDER BY j) AS r FROM entry GROUP BY 1)",
        "m0 AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM line)",
    ]
    for k in range(components):
        views += [
            f"p{k} AS (SELECT 0 AS step, m AS p FROM m{k} UNION ALL SELECT step + 1, list_transform(q, lambda r: list_transform(r, lambda x: x / t)) "
            f"FROM (SELECT step, q, list_sum(list_transform(range(1, {size + 1}), lambda i: q[i][i])) AS t "
            f"FROM (SELECT step, {product('p', 'p')} AS q FROM p{k} WHERE step < {squarings})))",
            f"w{k} AS (SELECT list_transform(p, lambda r: list_sum(list_transform(range(1, {size + 1}), lambda i: r[i] * (i + 0.5)))) AS w "
            f"FROM p{k} WHERE step = {squarings})",
            f"v{k} AS MATERIALIZED (SELECT list_transform(w, lambda x: x / sqrt(list_dot_product(w, w))) AS v FROM w{k})",
            f"l{k} AS MATERIALIZED (SELECT v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS value FROM m{k}, v{k})",
            f"m{k + 1} AS MATERIALIZED (SELECT list_transform(range(1, {size + 1}), lambda i: list_transform(range(1, {size + 1}), "
            f"lambda j: m[i][j] - value * v[i] * v[j])) AS m FROM m{k}, l{k})",
        ]
    rows = " UNION ALL ".join(f"SELECT {k} AS component, value FROM l{k}" for k in range(components))
    return "WITH RECURSIVE " + ",\n".join(views) + (
        f"\nSELECT component, round(value, 4) AS variance, (SELECT count(*) FROM customer) AS rows, round(value / {size}, 6) AS explained FROM ({rows})"
    )


SQL["pca_features"] = _pca_sql()

SQL["champion_chain"] = """
WITH hidden AS (
  SELECT 'C' || c_custkey AS customer_id, r_name AS predicted_risk_category
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_custkey % 5 = 0)
SELECT *, 1 AS version, 1.0::DOUBLE AS val_f1_score, true AS first_promoted, false AS second_promoted,
  count(*) OVER () AS total, count(*) OVER () AS correct, 1.0::DOUBLE AS accuracy FROM hidden"""

SQL["modularity"] = _with(HOLDING_GRAPH, """, c AS (SELECT 'C' || c_custkey AS id, c_mktsegment AS community_id FROM customer
    UNION ALL SELECT 'P' || p_partkey, p_brand FROM part),
  e AS (SELECT a.community_id AS ca, b.community_id AS cb FROM directed JOIN c a ON a.id = src JOIN c b ON b.id = dst),
  s AS (SELECT ca, count(*) AS tot, count(*) FILTER (WHERE ca = cb) AS ins FROM e GROUP BY 1), m AS (SELECT count(*)::DOUBLE AS m2 FROM e)
  SELECT count(*) AS communities, round(sum(ins / m2 - (tot / m2) * (tot / m2)), 9) AS modularity FROM s, m""")

SIMILAR = f"""{HOLDING_GRAPH},
common AS (SELECT x.src AS source, y.src AS target, count(*) AS shared FROM directed x JOIN directed y ON x.dst = y.dst
  WHERE x.src <> y.src GROUP BY 1, 2),
jac AS (SELECT source, target, shared::DOUBLE / (a.degree + b.degree - shared) AS similarity FROM common
  JOIN deg a ON a.id = source JOIN deg b ON b.id = target),
sim AS (SELECT source, target, similarity FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY similarity DESC, target) AS rn
  FROM jac WHERE similarity >= 0.05) WHERE rn <= 10),
cm AS (SELECT 'C' || c_custkey AS id, c_mktsegment AS community_id, c_acctbal FROM customer)"""
SQL["node_similarity"] = _with(SIMILAR, "SELECT source, target, round(similarity, 6) AS similarity FROM sim")
SQL["similarity_distribution"] = _with(SIMILAR, """SELECT count(*) AS pairs, count(DISTINCT source) AS nodes_compared,
  round(min(similarity), 6) AS min_similarity, round(avg(similarity), 6) AS mean_similarity, round(max(similarity), 6) AS max_similarity FROM sim""")
SQL["max_similarity"] = _with(SIMILAR, """SELECT id, round(max(similarity), 6) AS similarity_score FROM
  (SELECT source AS id, similarity FROM sim UNION ALL SELECT target, similarity FROM sim) GROUP BY 1""")
SQL["community_overlap"] = _with(SIMILAR, """SELECT CASE WHEN a.community_id = b.community_id THEN 'same' ELSE 'different' END AS community_match,
  count(*) AS pairs, round(avg(similarity), 6) AS avg_similarity
  FROM sim LEFT JOIN cm a ON a.id = source LEFT JOIN cm b ON b.id = target GROUP BY 1""")
SQL["spotlight_neighbors"] = _with(SIMILAR, """SELECT source, CAST(rank AS INTEGER) AS rank, target, round(similarity, 6) AS similarity,
  a.community_id, b.community_id AS neighbor_community FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY similarity DESC, target) AS rank FROM sim) s
  JOIN cm a ON a.id = source AND a.c_acctbal < 0 LEFT JOIN cm b ON b.id = target WHERE rank <= 5""")
SQL["knn"] = """WITH el AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
  n AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM el GROUP BY 1),
  u AS (SELECT vec_id, list(x / n ORDER BY i) AS u FROM el JOIN n USING (vec_id) GROUP BY 1),
  s AS (SELECT a.vec_id AS source, b.vec_id AS target, round(list_dot_product(a.u, b.u), 9) AS similarity
    FROM u a JOIN u b ON a.vec_id <> b.vec_id)
  SELECT source, target, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY similarity DESC, target) AS rank FROM s) WHERE rank <= 5"""

SQL["knn_of_embeddings"] = f"""WITH f AS ({_fastrp_sql()}),
  n AS (SELECT id, sqrt(sum(value * value)) AS n FROM f WHERE label = 'Customer' GROUP BY 1),
  u AS (SELECT id, list(CASE WHEN n > 0 THEN round(value / n, 12) ELSE value END ORDER BY dim) AS u FROM f JOIN n USING (id) GROUP BY 1),
  s AS (SELECT a.id AS source, b.id AS target, round(list_dot_product(a.u, b.u), 9) AS similarity FROM u a JOIN u b ON a.id <> b.id)
SELECT source, target, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY similarity DESC, target) AS rank FROM s) WHERE rank <= 5"""

# ------------------------------------------------------------------ features, splits, models

SQL["feature_table"] = _with(CUSTOMER, """SELECT c.customer_id, annual_income::DOUBLE AS annual_income, credit_score::DOUBLE AS credit_score,
  risk_profile AS risk_category, state AS community_id, """ + ", ".join(
    f"round(embedding[{i + 1}]::DOUBLE, 6) AS fastrp_{i}" for i in range(64)
) + " FROM customer_v c LEFT JOIN embeddings ON c.customer_id = 'C' || vec_id")


def _holdout(table: str, label: str, kept: int, seed: int) -> str:
    return (
        f"hold AS (SELECT customer_id, {label} AS t, {label} IS NOT NULL AND (CASE WHEN {label} IS NOT NULL THEN row_number() OVER "
        f"(PARTITION BY {label} ORDER BY md5('{seed}:' || customer_id), customer_id) END) > {kept} AS is_held_out FROM {table})"
    )


SQL["create_holdout"] = _with(f"{CUSTOMER}, {_holdout('customer_v', 'risk_profile', 20, 42)}", """SELECT customer_id,
  CASE WHEN NOT is_held_out THEN t END AS risk_category, t AS true_risk_category, is_held_out FROM hold""")
SQL["reapply_holdout"] = _with(f"{CUSTOMER}, {_holdout('customer_v', 'risk_profile', 20, 7)}", """SELECT customer_id,
  CASE WHEN NOT is_held_out THEN t END AS risk_category FROM hold""")
_RANKED = f"""{CUSTOMER}, rk AS (SELECT customer_id, risk_profile AS risk_category,
  row_number() OVER (PARTITION BY risk_profile ORDER BY md5('42:' || customer_id), customer_id) AS r,
  count(*) OVER (PARTITION BY risk_profile) AS n FROM customer_v WHERE risk_profile IS NOT NULL)"""
SQL["stratified_split"] = _with(_RANKED, "SELECT customer_id, risk_category, r <= round(n * 0.3) AS is_test FROM rk")
SQL["stratified_folds"] = _with(_RANKED, "SELECT customer_id, risk_category, CAST((r - 1) % 5 AS INTEGER) AS fold FROM rk")

NEAREST = """el AS (SELECT 'C' || vec_id AS id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
  n AS (SELECT id, sqrt(sum(x * x)) AS n FROM el GROUP BY 1),
  u AS (SELECT id, any_value('class ' || label) AS label, list(x / n ORDER BY i) AS u FROM el JOIN n USING (id) GROUP BY 1),
  s AS (SELECT a.id, a.label, b.label AS prediction, row_number() OVER (PARTITION BY a.id
    ORDER BY round(list_dot_product(a.u, b.u), 9) DESC, b.id) AS rk FROM u a JOIN u b ON a.id <> b.id),
  pr AS (SELECT id AS customer_id, label, prediction FROM s WHERE rk = 1),
  cf AS (SELECT label, prediction, count(*) AS n FROM pr GROUP BY 1, 2)"""
_CLASS = """, c AS (SELECT label FROM cf UNION SELECT prediction FROM cf),
  m AS (SELECT c.label, coalesce((SELECT sum(n) FROM cf WHERE cf.prediction = c.label), 0)::DOUBLE AS p,
    coalesce((SELECT sum(n) FROM cf WHERE cf.label = c.label), 0)::DOUBLE AS t,
    coalesce((SELECT sum(n) FROM cf WHERE cf.label = c.label AND cf.prediction = c.label), 0)::DOUBLE AS h FROM c)"""
SQL["confusion_matrix"] = _with(NEAREST, "SELECT label, prediction, n FROM cf")
SQL["class_metrics"] = _with(NEAREST, _CLASS + """ SELECT label, round(CASE WHEN p > 0 THEN h / p ELSE 0 END, 6) AS precision,
  round(CASE WHEN t > 0 THEN h / t ELSE 0 END, 6) AS recall, round(2 * h / (p + t), 6) AS f1, CAST(t AS BIGINT) AS support,
  CAST(h AS BIGINT) AS hits FROM m""")
SQL["macro_scores"] = _with(NEAREST, _CLASS + """ SELECT round(avg(2 * h / (p + t)), 6) AS macro_f1, round(sum(h) / sum(t), 6) AS accuracy,
  CAST(sum(t) AS BIGINT) AS rows FROM m""")
SQL["evaluate_predictions"] = _with(
    f"{NEAREST}, lv AS (SELECT 'C' || vec_id AS customer_id, 'class ' || label AS risk_category FROM embeddings), {_holdout('lv', 'risk_category', 10, 42)}",
    """SELECT count(*) AS total, count(*) FILTER (WHERE prediction = t) AS correct,
  round(count(*) FILTER (WHERE prediction = t) / count(*), 6) AS accuracy FROM pr JOIN hold USING (customer_id) WHERE is_held_out""")
SQL["promotion_decision"] = """WITH a AS (SELECT p_brand AS model_name, CAST(count(*) AS INTEGER) AS version, round(avg(p_size) / 50, 6) AS val_f1_score
    FROM part WHERE p_type = 'PROMO' GROUP BY 1),
  b AS (SELECT p_brand AS model_name, round(avg(p_size) / 50, 6) AS f FROM part WHERE p_type = 'ECONOMY' GROUP BY 1)
  SELECT model_name, version, val_f1_score, coalesce(f, 0) AS champion_f1, val_f1_score > coalesce(f, 0) AS promoted FROM a LEFT JOIN b USING (model_name)"""
SQL["compare_experiments"] = """WITH r AS (SELECT p_brand AS e, p_type AS model, round(avg(p_size) / 50, 6) AS f1 FROM part GROUP BY 1, 2),
  b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY e ORDER BY f1 DESC, model DESC) AS rn FROM r) WHERE rn = 1)
  SELECT 'run of ' || x.e AS label, f1, model FROM (SELECT DISTINCT p_brand AS e FROM part UNION ALL SELECT n_name FROM nation) x
  LEFT JOIN b ON b.e = x.e"""

SQL["enrichment_cycle"] = _with(GRAPH, f""", fresh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY source_document DESC) AS rn
    FROM batch_v WHERE confidence = 'high') b WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM log_v l WHERE
    l.relationship_type = b.relationship_type AND l.source_key_value = b.source_key_value AND l.target_key_value = b.target_key_value)),
  wr AS (SELECT * FROM fresh WHERE 'Customer:' || source_key_value IN (SELECT id FROM node)),
  nn AS (SELECT id FROM node UNION SELECT 'Item:' || target_key_value FROM wr),
  ne AS (SELECT src, dst, rel_type FROM old_edge UNION SELECT 'Customer:' || source_key_value, 'Item:' || target_key_value, relationship_type FROM wr),
  nl AS (SELECT {_KEY} FROM log_v UNION SELECT {_KEY} FROM wr),
  g AS (SELECT count(*) FILTER (WHERE confidence = 'high') AS h, count(*) FILTER (WHERE confidence = 'medium') AS m,
    count(*) FILTER (WHERE confidence = 'low') AS l FROM batch_v),
  c AS (SELECT unnest([1, 2])::INTEGER AS cycle)
  SELECT cycle, 'rejected' AS step, 0::BIGINT AS rows FROM c UNION ALL SELECT cycle, 'auto_approve', h FROM c, g
  UNION ALL SELECT cycle, 'flagged', m FROM c, g UNION ALL SELECT cycle, 'review', l FROM c, g
  UNION ALL SELECT cycle, 'fresh', CASE cycle WHEN 1 THEN (SELECT count(*) FROM fresh) ELSE (SELECT count(*) FROM fresh) - (SELECT count(*) FROM wr) END FROM c
  UNION ALL SELECT cycle, 'written', CASE cycle WHEN 1 THEN (SELECT count(*) FROM wr) ELSE 0 END FROM c
  UNION ALL SELECT cycle, 'nodes', (SELECT count(*) FROM nn) FROM c UNION ALL SELECT cycle, 'edges', (SELECT count(*) FROM ne) FROM c
  UNION ALL SELECT cycle, 'log_keys', (SELECT count(*) FROM nl) FROM c""")

SQL["holdout_counts"] = _with(f"{CUSTOMER}, {_holdout('customer_v', 'risk_profile', 20, 42)}", """SELECT t AS true_risk_category,
  count(*) FILTER (WHERE NOT is_held_out) AS kept, count(*) FILTER (WHERE is_held_out) AS held_out FROM hold WHERE t IS NOT NULL GROUP BY 1""")
SQL["representative_banks"] = """SELECT 'B' || n_nationkey AS bank_id, n_name AS name FROM nation
  ORDER BY md5('42:B' || n_nationkey), 'B' || n_nationkey LIMIT 6"""
SQL["property_writeback"] = _with(PORTFOLIO_GRAPH, """SELECT n.id, label, CASE WHEN label <> 'Account' THEN coalesce(degree, 0) END AS degree
  FROM gnode n LEFT JOIN deg d ON d.id = n.id""")

# ------------------------------------------------------------------ analysis contexts

_ANALYSES = {
    "interest_holding_gaps": "1_holdings", "risk_alignment": "2_profiles", "data_quality_gaps": "3_completeness",
    "investment_themes": None, "comprehensive": "all",
}
_ORDERED = "section, group_key, block, sub_key, item_key, line"


def _contexts_sql() -> str:
    parts = []
    for number, (name, section) in enumerate(_ANALYSES.items()):
        if section:
            where = "" if section == "all" else f" WHERE section = '{section}'"
            parts.append(f"SELECT '{name}' AS query_type, {_ORDERED} FROM lines{where}")
            parts.append(f"SELECT '{name}', '0_structured', '', 0, '', '', '## Structured Data (Portfolio / Account / Customer Data)'")
        rule = "---' || chr(10) || chr(10) || '" if section else ""
        parts.append(f"SELECT '{name}', '4_', '', 0, '', '', '{rule}## Document Excerpts (Customer Profiles, Market Research)'")
        parts.append(f"SELECT '{name}', '4_excerpts', '', rank, customer_key, '', line FROM ex WHERE query = '{number}'")
        parts.append(f"SELECT '{name}', {_ORDERED} FROM prior")
        parts.append(
            f"SELECT '{name}', '6_instructions', '', 0, '', '', '---' || chr(10) || chr(10) || '## Analysis Instructions' "
            f"|| chr(10) || chr(10) || '{name}'"
        )
    lines = " UNION ALL ".join(
        f"SELECT {_ORDERED} FROM ({SQL[n]})" for n in ("portfolio_context", "profile_context", "completeness_context")
    )
    return (
        f"WITH lines AS ({lines}), ex AS ({SQL['retrieval_context']}), prior AS ({SQL['prior_enrichments']})\n"
        + "\nUNION ALL ".join(parts)
    )


SQL["analysis_contexts"] = _contexts_sql()

# ------------------------------------------------------------------ reports in order

_REPORT_SORT = {
    "suspicious_communities": "account_count DESC NULLS LAST, community_id, bank_id, account_id",
    "structuring_accounts": "structuring_count DESC NULLS LAST, account_id",
    "flow_edges": "community_id, from_account, to_account",
    "coordinated_positions": "market_cap_billions, community_id, stock_id, account_id",
    "combined_risk": "risk_score DESC NULLS LAST, account_id, customer_id",
    "portfolio_holdings": "customer_id, sector, ticker, position_id",
    "portfolio_context": _ORDERED,
}
for _name, _sort in _REPORT_SORT.items():
    SQL[f"ordered_{_name}"] = f"SELECT *, row_number() OVER (ORDER BY {_sort}) AS position FROM ({SQL[_name]})"

SQL["prior_report"] = f"""WITH log_lines AS ({SQL['prior_enrichments']}), whole AS (
  SELECT 1 AS place, group_key, block, sub_key, item_key, line FROM log_lines
  UNION ALL SELECT DISTINCT 1, group_key, 2, '', '', '' FROM log_lines
  UNION ALL SELECT place, '', block, '', '', line FROM (VALUES (0, 0, '## Prior Enrichments (already written to graph)'), (0, 1, ''),
    (2, 0, 'Do NOT re-propose relationships that already appear above. Focus on discovering new gaps and patterns.'), (2, 1, ''))
    f(place, block, line) WHERE EXISTS (SELECT 1 FROM log_lines))
SELECT row_number() OVER (ORDER BY place, group_key, block, sub_key, item_key, line) AS position, line FROM whole"""
SQL["enrichment_totals"] = _with(PROPOSAL, "SELECT relationship_type, count(*) AS rows FROM log_v GROUP BY ROLLUP (relationship_type)")

_SUPPLIERS = "s AS (SELECT 'S' || s_suppkey AS id, s_nationkey AS nation FROM supplier)"
SQL["louvain_groups"] = f"WITH {_SUPPLIERS} SELECT id, 'Supplier' AS label, min(id) OVER (PARTITION BY nation) AS community_id FROM s"
SQL["louvain_group_stats"] = f"""WITH {_SUPPLIERS}, c AS (SELECT nation, count(*) AS n FROM s GROUP BY 1),
  m AS (SELECT sum(n * (n - 1)) AS rows FROM c)
SELECT (SELECT count(*) FROM s) AS node_count, rows::BIGINT AS relationship_count, count(*) AS community_count,
  round(CASE WHEN rows > 0 THEN 1 - sum((n * (n - 1) / rows) * (n * (n - 1) / rows)) ELSE 0 END, 6) AS modularity FROM c, m GROUP BY rows"""

# ------------------------------------------------------------------ whole tables of edges, keys and neighbors

SQL["derive_all_edges"] = """SELECT 'has_account' AS edge_table, 'C' || o_custkey AS source_key, 'A' || o_orderkey AS target_key
  FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT 'at_bank', 'A' || o_orderkey, 'B' || c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT 'of_company', 'S' || p_partkey, p_brand || '-' || p_type FROM part
  UNION ALL SELECT 'performs', 'A' || l_orderkey, 'T' || l_orderkey || '-' || l_linenumber FROM lineitem
  UNION ALL SELECT 'benefits_to', 'T' || l_orderkey || '-' || l_linenumber, 'A' || l_suppkey FROM lineitem
  UNION ALL SELECT DISTINCT 'has_position', 'A' || l_orderkey, 'H' || l_orderkey || '-' || l_partkey FROM lineitem
  UNION ALL SELECT DISTINCT 'of_security', 'H' || l_orderkey || '-' || l_partkey, 'S' || l_partkey FROM lineitem"""

_KEYS = {
    "Customer": "SELECT 'C' || c_custkey AS k FROM customer", "Account": "SELECT 'A' || o_orderkey FROM orders",
    "Bank": "SELECT 'B' || n_nationkey FROM nation", "Company": "SELECT p_brand || '-' || p_type FROM (SELECT DISTINCT p_brand, p_type FROM part)",
    "Stock": "SELECT 'S' || p_partkey FROM part",
    "Position": "SELECT 'H' || l_orderkey || '-' || l_partkey FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)",
    "Transaction": "SELECT 'T' || l_orderkey || '-' || l_linenumber FROM lineitem",
    "Document": "SELECT doc_id::VARCHAR FROM documents", "Chunk": "SELECT conv_id::VARCHAR FROM conversations",
}
SQL["all_key_violations"] = "\nUNION ALL ".join(
    f"SELECT '{label}' AS label, k AS key_value, count(*) AS copies FROM ({rows}) t(k) GROUP BY k HAVING count(*) > 1"
    for label, rows in _KEYS.items()
)

_KNN = f"k AS ({SQL['knn_of_embeddings']}), c AS (SELECT 'C' || c_custkey AS id, c_mktsegment AS m, replace(c_name, '#', ' ') AS name FROM customer)"
SQL["knn_community_overlap"] = f"""WITH {_KNN}
SELECT CASE WHEN a.m = b.m THEN 'same' ELSE 'different' END AS community_match, count(*) AS pairs, round(avg(similarity), 5) AS avg_similarity
FROM k LEFT JOIN c a ON a.id = source LEFT JOIN c b ON b.id = target GROUP BY 1"""
SQL["knn_neighbors_by_name"] = f"""WITH {_KNN}
SELECT a.name AS customer, a.m AS community_id, CAST(row_number() OVER (PARTITION BY source ORDER BY similarity DESC, target) AS INTEGER) AS position,
  b.name AS neighbor_name, b.m AS neighbor_community, similarity
FROM k JOIN c a ON a.id = source JOIN c b ON b.id = target WHERE a.name IN ('Customer 000000001', 'Customer 000000002', 'Customer 000000003')"""

SQL["ordered_customer_profiles"] = _with(CUSTOMER, """SELECT customer_id, first_name, last_name, NULL::VARCHAR AS email,
  NULL::VARCHAR AS city, state, annual_income, credit_score, risk_profile, NULL::DATE AS registration_date, NULL::DATE AS date_of_birth,
  NULL::VARCHAR AS employment_status, row_number() OVER (ORDER BY customer_id) AS position FROM customer_v""")
