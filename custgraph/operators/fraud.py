"""Fraud patterns over accounts, their transfers and their holdings.

Groups come as rows, one per member: the size of a group is aggregated first and
joined back, so no list of members is ever built in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import salted_join
from ..functions.text import full_name, money
from ..session import keep

STRUCTURING_LOW, STRUCTURING_HIGH = 8000, 10000  # fixed values: the band below the reporting limit
MIN_GROUP = 3  # fixed value: smallest pattern reported


def in_band(transactions: DataFrame, low: float = STRUCTURING_LOW, high: float = STRUCTURING_HIGH) -> DataFrame:
    """Transactions with ``low <= amount < high``."""
    return transactions.filter((F.col("amount") >= low) & (F.col("amount") < high))


def community_bank_groups(accounts: DataFrame, min_accounts: int = MIN_GROUP) -> DataFrame:
    """(community_id, bank_id, account_count) of communities clustered at one bank."""
    return (
        accounts.filter(F.col("community_id").isNotNull() & F.col("bank_id").isNotNull())
        .groupBy("community_id", "bank_id")
        .agg(F.count(F.lit(1)).alias("account_count"))
        .filter(F.col("account_count") >= min_accounts)
    )


def suspicious_communities(accounts: DataFrame, banks: DataFrame, min_accounts: int = MIN_GROUP) -> DataFrame:
    """Communities with several accounts at one bank, one row per account."""
    groups = community_bank_groups(accounts, min_accounts).join(
        banks.select("bank_id", F.col("name").alias("bank_name")), "bank_id"
    )
    members = accounts.select("community_id", "bank_id", "account_id", "risk_score", "similarity_score")
    return members.join(groups, ["community_id", "bank_id"])


def structuring_accounts(
    accounts: DataFrame, transactions: DataFrame, min_count: int = MIN_GROUP,
    low: float = STRUCTURING_LOW, high: float = STRUCTURING_HIGH,
) -> DataFrame:
    """Accounts that send several transactions just under the reporting limit."""
    sent = (
        in_band(transactions, low, high)
        .groupBy(F.col("from_account_id").alias("account_id"))
        .agg(
            F.count(F.lit(1)).alias("structuring_count"),
            F.round(F.avg("amount"), 2).alias("avg_amount"),
            F.round(F.sum("amount"), 2).alias("total_amount"),
            F.min("transaction_date").alias("first_date"),
            F.max("transaction_date").alias("last_date"),
        )
        .filter(F.col("structuring_count") >= min_count)
    )
    return sent.join(accounts.select("account_id", "risk_score", "community_id"), "account_id")


def community_transfers(
    accounts: DataFrame, transactions: DataFrame, low: float = STRUCTURING_LOW, high: float = STRUCTURING_HIGH
) -> DataFrame:
    """(community_id, from_account, to_account, txn_count, total) inside one community.

    Transfers are summed per account pair before the communities are looked up, so
    the two joins see each pair once; a hot sender or receiver is spread by salt.
    """
    pairs = keep(
        in_band(transactions, low, high)
        .groupBy(F.col("from_account_id").alias("from_account"), F.col("to_account_id").alias("to_account"))
        .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total"))
    )
    known = accounts.filter(F.col("community_id").isNotNull())
    senders = known.select(F.col("account_id").alias("from_account"), "community_id")
    receivers = known.select(F.col("account_id").alias("to_account"), F.col("community_id").alias("_to"))
    sent = salted_join(pairs, senders, "from_account", ["to_account"])
    both = salted_join(sent, receivers, "to_account", ["from_account"], measure=pairs)
    return both.filter(F.col("community_id") == F.col("_to")).drop("_to")


def flow_edges(transfers: DataFrame) -> DataFrame:
    """Directed account pairs with count and rounded total."""
    return transfers.select(
        "community_id", "from_account", "to_account", "txn_count",
        F.round("total", 2).alias("total_amount"),
    )


def flow_rings(transfers: DataFrame, min_size: int = MIN_GROUP) -> DataFrame:
    """Accounts that both send and receive inside their community, one row per member."""
    sides = transfers.select(
        "community_id",
        F.explode(
            F.array(
                F.struct(F.col("from_account").alias("account_id"), F.lit(1).alias("sends"), F.lit(0).alias("receives")),
                F.struct(F.col("to_account").alias("account_id"), F.lit(0).alias("sends"), F.lit(1).alias("receives")),
            )
        ).alias("side"),
    ).select("community_id", "side.*")
    members = (
        sides.groupBy("community_id", "account_id")
        .agg(F.max("sends").alias("sends"), F.max("receives").alias("receives"))
        .filter((F.col("sends") == 1) & (F.col("receives") == 1))
        .select("community_id", "account_id")
    )
    sizes = members.groupBy("community_id").agg(F.count(F.lit(1)).alias("ring_size"))
    return members.join(sizes.filter(F.col("ring_size") >= min_size), "community_id")


def _holders(accounts: DataFrame, positions: DataFrame) -> DataFrame:
    """(account_id, stock_id, community_id), one row per holder of a stock."""
    held = positions.select("account_id", "stock_id").distinct()
    known = accounts.filter(F.col("community_id").isNotNull()).select("account_id", "community_id")
    return held.join(known, "account_id")


def position_groups(
    accounts: DataFrame, positions: DataFrame, stocks: DataFrame, companies: DataFrame, min_holders: int = MIN_GROUP
) -> DataFrame:
    """Stocks held by several accounts of one community, one row per community and stock."""
    groups = (
        _holders(accounts, positions)
        .groupBy("community_id", "stock_id")
        .agg(F.count(F.lit(1)).alias("holder_count"))
        .filter(F.col("holder_count") >= min_holders)
    )
    return groups.join(
        stocks.select("stock_id", "ticker", "company_id", "market_cap_billions"), "stock_id"
    ).join(companies.select("company_id", F.col("name").alias("company_name")), "company_id").drop("company_id")


def position_members(accounts: DataFrame, positions: DataFrame, groups: DataFrame) -> DataFrame:
    """The holders of each group, one row per holder."""
    return _holders(accounts, positions).join(groups, ["community_id", "stock_id"]).select(
        "community_id", "stock_id", "ticker", "company_name", "market_cap_billions", "account_id", "holder_count"
    )


def coordinated_positions(
    accounts: DataFrame, positions: DataFrame, stocks: DataFrame, companies: DataFrame, min_holders: int = MIN_GROUP
) -> DataFrame:
    """Stocks held by several accounts of one community, one row per holder."""
    return position_members(accounts, positions, position_groups(accounts, positions, stocks, companies, min_holders))


# Order in which the signals of one account are listed.
SIGNAL_ORDER = {"structuring": 1, "circular_flow": 2, "coordinated_position": 3}


def risk_signals(structuring: DataFrame, rings: DataFrame, positions: DataFrame) -> DataFrame:
    """(account_id, signal_order, signal) rows; a position counts only for an account
    that structuring or a ring has flagged already."""
    def kind(name: str):
        return F.lit(SIGNAL_ORDER[name]).alias("signal_order")

    flagged = structuring.select("account_id").union(rings.select("account_id")).distinct()
    parts = [
        structuring.select(
            "account_id", kind("structuring"),
            F.concat(F.lit("structuring: "), F.col("structuring_count"), F.lit(" txns, avg "), money("avg_amount")).alias("signal"),
        ),
        rings.select(
            "account_id", kind("circular_flow"),
            F.concat(F.lit("circular_flow: "), F.col("ring_size"), F.lit("-account ring")).alias("signal"),
        ),
        positions.join(flagged, "account_id", "left_semi").select(
            "account_id", kind("coordinated_position"),
            F.concat(F.lit("coordinated_position: "), "ticker", F.lit(" ("), money("market_cap_billions"), F.lit("B mcap)")).alias("signal"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def combined_risk(signals: DataFrame, customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row per flagged account with its owner and signal counts; an account
    without an owner is left out."""
    counted = signals.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("signal_count"),
        *[
            F.max(F.when(F.col("signal_order") == order, F.col("signal"))).alias(name)
            for name, order in SIGNAL_ORDER.items()
            if name != "coordinated_position"
        ],
        F.count_if(F.col("signal_order") == SIGNAL_ORDER["coordinated_position"]).alias("position_signals"),
    )
    owners = customers.select(
        "customer_id", full_name("first_name", "last_name").alias("customer_name"), "annual_income", "credit_score"
    )
    details = accounts.select(
        "account_id", "customer_id", "account_type", "risk_score", "community_id", "similarity_score"
    )
    return counted.join(details, "account_id").join(owners, "customer_id")


def fraud_summary(
    bank_groups: DataFrame, structuring: DataFrame, flows: DataFrame, rings: DataFrame,
    stock_groups: DataFrame, combined: DataFrame,
) -> DataFrame:
    """Size of each section of the report as (section, entries); the groups have a row each."""
    def size(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("entries")).select(F.lit(name).alias("section"), "entries")

    parts = [
        size("suspicious_communities", bank_groups),
        size("structuring_accounts", structuring),
        size("circular_flow_edges", flows),
        size("circular_flow_rings", rings.select("community_id").distinct()),
        size("coordinated_positions", stock_groups),
        size("flagged_accounts", combined),
        size("flagged_customers", combined.select("customer_id").distinct()),
    ]
    return reduce(DataFrame.unionByName, parts)


def property_coverage(accounts: DataFrame) -> DataFrame:
    """How many accounts carry each computed property, in one row."""
    return accounts.agg(
        F.count(F.lit(1)).alias("total_accounts"),
        F.count("risk_score").alias("with_risk_score"),
        F.count("community_id").alias("with_community"),
        F.count("similarity_score").alias("with_similarity"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.count_distinct("community_id").alias("communities"),
    )
