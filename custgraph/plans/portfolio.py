"""The portfolio tables seen through the star-schema test tables.

Orders stand for accounts, parts for stocks, brand and type for companies, line items
for holdings and transfers, events for proposed edges. Every frame is lazy and reads
only the columns its query needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.skew import deal

LOG_UNTIL = "2024-01-21"


class Portfolio:
    """Lazy views over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def rows(self, name: str) -> int:
        """Rows of a table; Parquet files name it in their footers."""
        return self.raw(name).count()

    def _lots(self, *columns: str) -> DataFrame:
        """Columns of the line items, dealt by order and part, which hardly repeat."""
        lots = self.raw("lineitem").select("l_orderkey", "l_partkey", *columns)
        return deal(lots, self.rows("lineitem"), "l_orderkey", "l_partkey")

    @staticmethod
    def tag(prefix: str, column: str) -> Column:
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    # ------------------------------------------------------------ node tables

    def customer(self) -> DataFrame:
        name = F.split("c_name", "#")
        null = F.lit(None)
        return self.raw("customer").select(
            self.tag("C", "c_custkey").alias("customer_id"),
            F.get(name, F.lit(0)).alias("first_name"),
            F.get(name, F.lit(1)).alias("last_name"),
            null.cast("string").alias("email"),
            null.cast("string").alias("phone"),
            null.cast("string").alias("city"),
            F.col("c_nationkey").cast("string").alias("state"),
            null.cast("date").alias("registration_date"),
            null.cast("date").alias("date_of_birth"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("risk_profile"),
            null.cast("string").alias("employment_status"),
            F.floor("c_acctbal").cast("int").alias("annual_income"),
            F.floor(300 + (F.col("c_acctbal") + 1000) / 20).cast("int").alias("credit_score"),
        )

    def account(self) -> DataFrame:
        return self.raw("orders").select(
            self.tag("A", "o_orderkey").alias("account_id"),
            self.tag("C", "o_custkey").alias("customer_id"),
            F.col("o_orderpriority").alias("account_type"),
            F.col("o_totalprice").alias("balance"),
            F.to_date("o_orderdate").alias("opened_date"),
            F.col("o_orderstatus").alias("status"),
            F.lit(None).cast("double").alias("interest_rate"),
        )

    def account_at_bank(self) -> DataFrame:
        """Accounts with the bank of their owner's nation."""
        bank = self.raw("customer").select(
            self.tag("C", "c_custkey").alias("customer_id"), self.tag("B", "c_nationkey").alias("bank_id")
        )
        return self.account().join(bank, "customer_id")

    def bank(self) -> DataFrame:
        return self.raw("nation").select(self.tag("B", "n_nationkey").alias("bank_id"), F.col("n_name").alias("name"))

    def stock(self) -> DataFrame:
        return self.raw("part").select(
            self.tag("S", "p_partkey").alias("stock_id"),
            F.col("p_name").alias("ticker"),
            F.concat_ws("-", "p_brand", "p_type").alias("company_id"),
            F.col("p_retailprice").alias("current_price"),
            (F.col("p_retailprice") / 1000).alias("market_cap_billions"),
        )

    def company(self) -> DataFrame:
        return self.raw("part").select(
            F.concat_ws("-", "p_brand", "p_type").alias("company_id"),
            F.col("p_brand").alias("name"),
            F.col("p_brand").alias("ticker_symbol"),
            F.col("p_type").alias("sector"),
        ).distinct()

    def position(self) -> DataFrame:
        """One position per account and stock: the lots of the same stock are summed."""
        return (
            self._lots("l_quantity", "l_extendedprice", "l_discount")
            .groupBy("l_orderkey", "l_partkey")
            .agg(
                F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("v"), F.max("l_discount").alias("d")
            )
            .select(
                F.concat(F.lit("H"), F.col("l_orderkey"), F.lit("-"), F.col("l_partkey")).alias("position_id"),
                self.tag("A", "l_orderkey").alias("account_id"),
                self.tag("S", "l_partkey").alias("stock_id"),
                F.col("q").cast("int").alias("shares"),
                (F.col("v") / F.col("q")).alias("purchase_price"),
                F.col("v").alias("current_value"),
                (F.col("d") * 100).alias("percentage_of_portfolio"),
            )
        )

    def payment(self) -> DataFrame:
        """Lots as payments from the account of the order to that of the supplier."""
        return self.raw("lineitem").select(
            F.concat(F.lit("T"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("transaction_id"),
            self.tag("A", "l_orderkey").alias("from_account_id"), self.tag("A", "l_suppkey").alias("to_account_id"),
        )

    def tables(self) -> dict[str, DataFrame]:
        return {
            "customer": self.customer(), "account": self.account(), "bank": self.bank(),
            "company": self.company(), "stock": self.stock(), "position": self.position(),
        }

    def sector_lots(self) -> DataFrame:
        """(customer_id, sector, current_value) of every lot, for sums that need no position."""
        lots = self.raw("lineitem").select("l_orderkey", "l_partkey", F.col("l_extendedprice").alias("current_value"))
        owners = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        sectors = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("sector"))
        return lots.join(sectors, "l_partkey").join(owners, "l_orderkey").select(
            self.tag("C", "o_custkey").alias("customer_id"), "sector", "current_value"
        )

    # ------------------------------------------------------------ fraud views

    def fraud_account(self) -> DataFrame:
        """Customers as accounts: segment as community, nation as bank."""
        return self.raw("customer").select(
            self.tag("C", "c_custkey").alias("account_id"),
            self.tag("C", "c_custkey").alias("customer_id"),
            F.lit("customer").alias("account_type"),
            self.tag("B", "c_nationkey").alias("bank_id"),
            F.col("c_mktsegment").alias("community_id"),
            (F.col("c_acctbal") / 1000).alias("risk_score"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 10000).alias("similarity_score"),
        )

    def transaction(self) -> DataFrame:
        """Line items as transfers from the buyer to the account numbered like the supplier."""
        sent = self.raw("lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate")
        owners = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        return sent.join(owners, "l_orderkey").select(
            self.tag("C", "o_custkey").alias("from_account_id"),
            self.tag("C", "l_suppkey").alias("to_account_id"),
            F.col("l_extendedprice").alias("amount"),
            F.to_date("l_shipdate").alias("transaction_date"),
        )

    def fraud_position(self) -> DataFrame:
        """(account_id, stock_id): which customer holds which stock."""
        held = self.raw("lineitem").select("l_orderkey", "l_partkey")
        owners = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        return held.join(owners, "l_orderkey").select(
            self.tag("C", "o_custkey").alias("account_id"), self.tag("S", "l_partkey").alias("stock_id")
        )

    # ------------------------------------------------------------ graph views

    def graph_nodes(self) -> DataFrame:
        """Customers, orders and parts as (id, label)."""
        def part(table: str, key: str, prefix: str, label: str) -> DataFrame:
            return self.raw(table).select(self.tag(prefix, key).alias("id"), F.lit(label).alias("label"))

        return (
            part("customer", "c_custkey", "C", "Customer")
            .unionByName(part("orders", "o_orderkey", "O", "Account"))
            .unionByName(part("part", "p_partkey", "P", "Stock"))
        )

    def graph_edges(self) -> DataFrame:
        """Customer to order and order to part."""
        owns = self.raw("orders").select(
            self.tag("C", "o_custkey").alias("src"), F.lit("Customer").alias("src_label"),
            self.tag("O", "o_orderkey").alias("dst"), F.lit("Account").alias("dst_label"),
            F.lit("HAS_ACCOUNT").alias("rel_type"),
        )
        holds = self._lots().distinct().select(
            self.tag("O", "l_orderkey").alias("src"), F.lit("Account").alias("src_label"),
            self.tag("P", "l_partkey").alias("dst"), F.lit("Stock").alias("dst_label"),
            F.lit("HAS_POSITION").alias("rel_type"),
        )
        return owns.unionByName(holds)

    def holding_nodes(self) -> DataFrame:
        return self.graph_nodes().filter(F.col("label") != "Account")

    def holding_edges(self) -> DataFrame:
        """Customer to part, one edge per pair."""
        held = self.raw("lineitem").select("l_orderkey", "l_partkey")
        owners = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        return held.join(owners, "l_orderkey").select("o_custkey", "l_partkey").distinct().select(
            self.tag("C", "o_custkey").alias("src"), F.lit("Customer").alias("src_label"),
            self.tag("P", "l_partkey").alias("dst"), F.lit("Stock").alias("dst_label"),
            F.lit("HOLDS").alias("rel_type"),
        )

    def communities(self) -> DataFrame:
        """(id, community_id) of the customers."""
        return self.raw("customer").select(
            self.tag("C", "c_custkey").alias("id"), F.col("c_mktsegment").alias("community_id")
        )

    # ------------------------------------------------------------ proposals

    def proposals(self) -> DataFrame:
        """Events as proposed edges from a customer to an item."""
        level = F.when(F.col("value") >= 300, "high").when(F.col("value") >= 100, "medium").otherwise("low")
        return self._events().select(
            F.upper("event_type").alias("relationship_type"),
            F.lit("Customer").alias("source_label"),
            F.lit("customer_id").alias("source_key_property"),
            self.tag("C", "user_id").alias("source_key_value"),
            F.lit("Item").alias("target_label"),
            F.lit("item_id").alias("target_key_property"),
            self.tag("I", "k").alias("target_key_value"),
            F.create_map(F.lit("value"), F.col("value").cast("string")).alias("properties"),
            level.alias("confidence"),
            F.lpad(F.col("event_id").cast("string"), 20, "0").alias("source_document"),
            F.col("event_type").alias("extracted_phrase"),
            F.col("props").alias("rationale"),
            F.col("ts").alias("proposed_at"),
        )

    def _events(self) -> DataFrame:
        return self.raw("events").withColumn("k", F.get_json_object("props", "$.k"))

    def log(self) -> DataFrame:
        """Proposals of earlier runs."""
        return self.proposals().filter(F.col("proposed_at") < F.lit(LOG_UNTIL).cast("timestamp_ntz"))

    def batch(self) -> DataFrame:
        """Proposals of this run."""
        return self.proposals().filter(F.col("proposed_at") >= F.lit(LOG_UNTIL).cast("timestamp_ntz"))

    # ------------------------------------------------------------ documents

    def document(self) -> DataFrame:
        """Documents titled with the customer of the same number."""
        return self.raw("documents").select(
            F.col("doc_id").alias("document_id"),
            F.concat(F.lit("Customer Profile - Customer "), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("title"),
            F.when(F.col("lang") == "en", "customer_profile").otherwise("market_analysis").alias("document_type"),
            "text",
        )

    def conversation_chunks(self) -> DataFrame:
        """Turns as the ordered chunks of a conversation."""
        return self.raw("conversations").select(
            F.concat_ws("-", "conv_id", "turn").alias("chunk_id"),
            F.col("conv_id").alias("document_id"),
            F.col("turn").alias("index"),
            "text",
        )

    def vector_chunks(self) -> DataFrame:
        """Vectors as chunks of the document with the same number."""
        return self.raw("embeddings").select(
            F.col("vec_id").alias("chunk_id"), F.col("vec_id").alias("document_id"),
            F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("text"),
            F.col("embedding").cast("array<double>").alias("embedding"), "label",
        )

    def label_centroids(self) -> dict[str, list[float]]:
        """The mean vector per label: one small row per label, used as query vectors."""
        parts = self.raw("embeddings").select("label", F.posexplode(F.col("embedding").cast("array<double>")))
        means = parts.groupBy("label", "pos").agg(F.avg("col").alias("m"))
        rows = means.groupBy("label").agg(
            F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("v")
        ).select("label", F.col("v.m").alias("v")).collect()
        return {str(r["label"]): r["v"] for r in sorted(rows, key=lambda r: r["label"])}
