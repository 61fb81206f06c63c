"""Node, edge and record schemas of the customer graph: names and types only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class NodeSpec:
    """One node table: label, key column, table name, CSV file and typed columns.

    ``fields`` lists ``name type`` pairs; ``raw>name type`` renames a CSV column.
    """

    label: str
    key: str
    table: str
    file: str
    fields: str

    def columns(self) -> list[tuple[str, str, str]]:
        """(raw name, name, type) per column."""
        out = []
        for item in self.fields.split(","):
            name, kind = item.split()
            raw, _, renamed = name.partition(">")
            out.append((raw, renamed or raw, kind))
        return out


@dataclass(frozen=True)
class EdgeSpec:
    """One relationship type, its endpoints and the node table its rows come from."""

    rel_type: str
    source_label: str
    source_key: str
    target_label: str
    target_key: str
    from_table: str
    source_column: str
    target_column: str

    @property
    def table(self) -> str:
        return self.rel_type.lower()


# Column names and types of the CSV inputs.
NODES: dict[str, NodeSpec] = {
    spec.table: spec
    for spec in (
        NodeSpec(
            "Customer", "customer_id", "customer", "customers.csv",
            "customer_id string, first_name string, last_name string, email string, phone string,"
            "address string, city string, state string, zip_code string, registration_date date,"
            "date_of_birth date, risk_profile string, employment_status string,"
            "annual_income int, credit_score int",
        ),
        NodeSpec(
            "Bank", "bank_id", "bank", "banks.csv",
            "bank_id string, name string, headquarters string, bank_type string,"
            "total_assets_billions double, established_year int, routing_number string, swift_code string",
        ),
        NodeSpec(
            "Account", "account_id", "account", "accounts.csv",
            "account_id string, account_number string, customer_id string, bank_id string,"
            "account_type string, balance double, currency string, opened_date date,"
            "status string, interest_rate double",
        ),
        NodeSpec(
            "Company", "company_id", "company", "companies.csv",
            "company_id string, name string, ticker_symbol string, industry string, sector string,"
            "market_cap_billions double, headquarters string, founded_year int, ceo string,"
            "employee_count int, annual_revenue_billions double",
        ),
        NodeSpec(
            "Stock", "stock_id", "stock", "stocks.csv",
            "stock_id string, ticker string, company_id string, current_price double,"
            "previous_close double, opening_price double, day_high double, day_low double, volume int,"
            "market_cap_billions double, pe_ratio double, dividend_yield double,"
            "fifty_two_week_high double, fifty_two_week_low double, exchange string",
        ),
        NodeSpec(
            "Position", "position_id", "position", "portfolio_holdings.csv",
            "holding_id>position_id string, account_id string, stock_id string, shares int,"
            "purchase_price double, purchase_date date, current_value double,"
            "percentage_of_portfolio double",
        ),
        NodeSpec(
            "Transaction", "transaction_id", "transaction", "transactions.csv",
            "transaction_id string, from_account_id string, to_account_id string, amount double,"
            "currency string, transaction_date date, transaction_time string, type string,"
            "status string, description string",
        ),
    )
}

# Relationship types and the columns they join.
EDGES: dict[str, EdgeSpec] = {
    spec.table: spec
    for spec in (
        EdgeSpec("HAS_ACCOUNT", "Customer", "customer_id", "Account", "account_id", "account", "customer_id", "account_id"),
        EdgeSpec("AT_BANK", "Account", "account_id", "Bank", "bank_id", "account", "account_id", "bank_id"),
        EdgeSpec("OF_COMPANY", "Stock", "stock_id", "Company", "company_id", "stock", "stock_id", "company_id"),
        EdgeSpec("PERFORMS", "Account", "account_id", "Transaction", "transaction_id", "transaction", "from_account_id", "transaction_id"),
        EdgeSpec("BENEFITS_TO", "Transaction", "transaction_id", "Account", "account_id", "transaction", "transaction_id", "to_account_id"),
        EdgeSpec("HAS_POSITION", "Account", "account_id", "Position", "position_id", "position", "account_id", "position_id"),
        EdgeSpec("OF_SECURITY", "Position", "position_id", "Stock", "stock_id", "position", "position_id", "stock_id"),
    )
}

# Unique key per label, the document labels included.
UNIQUE_KEYS: dict[str, str] = {spec.label: spec.key for spec in NODES.values()} | {
    "Document": "document_id",
    "Chunk": "chunk_id",
}

# Labels and types of the feature projection; the fraud projection takes all.
FEATURE_LABELS = ("Customer", "Account", "Position", "Stock", "Company")
FEATURE_TYPES = ("HAS_ACCOUNT", "HAS_POSITION", "OF_SECURITY", "OF_COMPANY")

CONFIDENCE_LEVELS = ("high", "medium", "low")

DEDUP_KEY = ("relationship_type", "source_label", "source_key_value", "target_label", "target_key_value")

PROVENANCE = ("confidence", "source_document", "extracted_phrase", "enrichment_timestamp", "run_id")


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


NODE_REFERENCE = T.StructType(_strings("label", "key_property", "key_value"))

PROPOSAL = T.StructType(
    [
        T.StructField("source_node", NODE_REFERENCE),
        T.StructField("target_node", NODE_REFERENCE),
        T.StructField("relationship_type", T.StringType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        *_strings("confidence", "source_document", "extracted_phrase", "rationale"),
    ]
)

ENRICHMENT_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("enrichment_timestamp", T.TimestampType()),
        *_strings(
            "relationship_type", "source_label", "source_key_property", "source_key_value",
            "target_label", "target_key_property", "target_key_value", "confidence",
            "source_document", "extracted_phrase", "rationale", "properties_json",
        ),
    ]
)

_CHUNK_META = T.StructType(
    _strings(
        "document_title", "document_type", "source_path",
        "section_header", "section_subheader", "section_detail",
    )
)

EMBEDDINGS_FILE = T.StructType(
    [
        T.StructField(
            "metadata",
            T.StructType(
                _strings("generated_at", "embedding_model")
                + [
                    T.StructField(name, T.IntegerType())
                    for name in (
                        "embedding_dimensions", "chunk_size", "chunk_overlap",
                        "document_count", "chunk_count",
                    )
                ]
            ),
        ),
        T.StructField(
            "documents",
            T.ArrayType(
                T.StructType(
                    _strings("document_id", "filename", "document_type", "title", "source_path")
                    + [
                        T.StructField("char_count", T.IntegerType()),
                        T.StructField(
                            "entity_references",
                            T.StructType(
                                [
                                    T.StructField(name, T.ArrayType(T.StringType()))
                                    for name in ("customers", "companies", "stock_tickers")
                                ]
                            ),
                        ),
                    ]
                )
            ),
        ),
        T.StructField(
            "chunks",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("chunk_id", T.StringType()),
                        T.StructField("index", T.IntegerType()),
                        T.StructField("text", T.StringType()),
                        T.StructField("document_id", T.StringType()),
                        T.StructField("metadata", _CHUNK_META),
                        T.StructField("embedding", T.ArrayType(T.DoubleType())),
                    ]
                )
            ),
        ),
    ]
)

_SUGGESTION = _strings("confidence", "source_evidence", "rationale")

# The four analyses of one result file, reduced to the fields the statistics use.
ANALYSIS_RESULT = T.StructType(
    [
        T.StructField(
            "investment_themes",
            T.StructType(
                _strings("summary")
                + [
                    T.StructField(
                        "themes",
                        T.ArrayType(
                            T.StructType(
                                _strings("name", "description", "market_size", "growth_projection")
                                + [
                                    T.StructField("key_sectors", T.ArrayType(T.StringType())),
                                    T.StructField("key_companies", T.ArrayType(T.StringType())),
                                ]
                                + _strings("confidence", "source_evidence")
                            )
                        ),
                    )
                ]
            ),
        ),
        T.StructField(
            "new_entities",
            T.StructType(
                _strings("summary")
                + [
                    T.StructField(
                        "suggested_nodes",
                        T.ArrayType(
                            T.StructType(_strings("label", "description", "key_property") + _SUGGESTION)
                        ),
                    )
                ]
            ),
        ),
        T.StructField(
            "missing_attributes",
            T.StructType(
                _strings("summary")
                + [
                    T.StructField(
                        "suggested_attributes",
                        T.ArrayType(
                            T.StructType(
                                _strings("target_label", "property_name", "property_type", "description")
                                + _SUGGESTION
                            )
                        ),
                    )
                ]
            ),
        ),
        T.StructField(
            "implied_relationships",
            T.StructType(
                _strings("summary")
                + [
                    T.StructField(
                        "suggested_relationships",
                        T.ArrayType(
                            T.StructType(
                                _strings("relationship_type", "description", "source_label", "target_label")
                                + _SUGGESTION
                            )
                        ),
                    )
                ]
            ),
        ),
    ]
)
