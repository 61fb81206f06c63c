"""Questions about customers, accounts and holdings, and the text contexts made of them.

A context is a table of ordered lines, not one string: a customer with very many
holdings stays many rows, and ``write_lines`` sorts them out to text files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import full_name, is_populated, money, percent, safe_float

PROFILE_COLUMNS = (
    "customer_id", "first_name", "last_name", "email", "city", "state", "annual_income",
    "credit_score", "date_of_birth", "registration_date", "risk_profile", "employment_status",
)

# Attributes the profile documents mention and the customer table lacks.
EXPECTED_ATTRIBUTES = (
    ("occupation", "Job title and role"),
    ("employer", "Company or organization"),
    ("investment_philosophy", "Investment approach and strategy"),
    ("life_stage", "Career/life stage (mid-career, pre-retirement, etc.)"),
    ("financial_goals", "Stated financial objectives"),
    ("communication_preference", "Preferred contact method"),
)


def customer_profiles(customers: DataFrame) -> DataFrame:
    return customers.select(*PROFILE_COLUMNS)


def customer_accounts(accounts: DataFrame) -> DataFrame:
    """Accounts by owner."""
    return accounts.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", "account_id", "account_type", "balance", "status", "interest_rate"
    )


def portfolio_holdings(tables: Mapping[str, DataFrame], edges: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Customer, account, position, stock and company in one row per position.

    Without ``edges`` the foreign keys of the node tables are the joins, which is the
    same result when the edge tables are projections of them and saves four shuffles.
    With ``edges`` all nine tables are joined, for graphs that gained edges later.
    """
    customer, account, position, stock, company = (
        tables[t] for t in ("customer", "account", "position", "stock", "company")
    )
    if edges is None:
        joined = (
            position.join(stock, "stock_id")
            .join(company.withColumnRenamed("name", "company_name"), "company_id")
            .join(account, "account_id")
            .join(customer, "customer_id")
        )
    else:
        def pairs(name: str, source: str, target: str) -> DataFrame:
            df = edges[name]
            return df.select(F.col(f"`{df.columns[0]}`").alias(source), F.col(f"`{df.columns[1]}`").alias(target))

        joined = (
            customer.join(pairs("has_account", "customer_id", "account_id"), "customer_id")
            .join(account.drop("customer_id", "bank_id"), "account_id")
            .join(pairs("has_position", "account_id", "position_id"), "account_id")
            .join(position.drop("account_id", "stock_id"), "position_id")
            .join(pairs("of_security", "position_id", "stock_id"), "position_id")
            .join(stock.drop("company_id"), "stock_id")
            .join(pairs("of_company", "stock_id", "company_id"), "stock_id")
            .join(company.withColumnRenamed("name", "company_name"), "company_id")
        )
    return joined.select(
        "customer_id", "first_name", "last_name", "account_id", "account_type", "position_id",
        "ticker", "current_price", "company_name", "sector", "shares", "purchase_price",
        "current_value", "percentage_of_portfolio",
    )


def sector_exposure(holdings: DataFrame) -> DataFrame:
    """Value and share of each sector in a customer's portfolio.

    Holdings are summed per (customer, sector) before the total is taken, so the
    window sees one row per sector and never the holdings of a large customer.
    """
    return _shares(
        holdings.groupBy("customer_id", F.coalesce(F.col("sector"), F.lit("Unknown")).alias("sector")).agg(
            F.sum(safe_float("current_value")).alias("sector_value")
        )
    )


def _shares(values: DataFrame) -> DataFrame:
    total = F.sum("sector_value").over(Window.partitionBy("customer_id"))
    share = F.when(F.col("total_value") != 0, F.col("sector_value") / F.col("total_value") * 100)
    return values.withColumn("total_value", total).withColumn(
        "sector_pct", F.coalesce(share, F.lit(0.0))
    )


def account_summary(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts per customer: how many and what they hold; customers without any stay."""
    totals = accounts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("account_count"),
        F.sum(safe_float("balance")).alias("total_balance"),
        F.min("account_id").alias("first_account_id"),
    )
    return customers.select("customer_id").join(totals, "customer_id", "left").select(
        "customer_id",
        F.coalesce("account_count", F.lit(0)).alias("account_count"),
        F.coalesce("total_balance", F.lit(0.0)).alias("total_balance"),
        "first_account_id",
    )


def data_completeness(df: DataFrame) -> DataFrame:
    """Populated rows and percent per column, in one pass over the table."""
    fields = [c for c in df.columns if not c.startswith("<")]
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(is_populated(F.col(f"`{c}`"))).alias(c) for c in fields],
    )
    rows = counts.unpivot(["total_rows"], fields, "field", "populated")
    share = F.when(F.col("total_rows") > 0, F.col("populated") / F.col("total_rows") * 100)
    return rows.withColumn("pct", F.coalesce(share, F.lit(0.0)))


def missing_fields(spark: SparkSession, columns: Sequence[str], expected=EXPECTED_ATTRIBUTES) -> DataFrame:
    """Expected attributes that are not among the columns of the table."""
    rows = [(name, text) for name, text in expected if name not in set(columns)]
    return spark.createDataFrame(rows, "field string, description string")


def sample_customers(customers: DataFrame, count: int = 5) -> DataFrame:
    """The first customers by id with yes/no flags for their contact columns."""
    def flag(name: str):
        return F.when(is_populated(name), "yes").otherwise("no")

    return customers.orderBy("customer_id").limit(count).select(
        "customer_id", "first_name", "last_name", flag("email").alias("has_email"),
        flag("phone").alias("has_phone"), "annual_income", "credit_score",
    )


def label_counts(customers: DataFrame, label: str = "risk_profile") -> DataFrame:
    """Labeled and unlabeled customers, null and blank alike."""
    state = F.when(is_populated(label), "labeled").otherwise("unlabeled")
    return customers.groupBy(state.alias("label_state")).agg(F.count(F.lit(1)).alias("customers"))


# --------------------------------------------------------------------------- lines

LINE_ORDER = ("section", "group_key", "block", "sub_key", "item_key")


def _lines(df: DataFrame, section: str, group, block: int, sub, item, line) -> DataFrame:
    """Rows of the line table: five sort columns and the text."""
    return df.select(
        F.lit(section).alias("section"),
        F.col(group).cast("string").alias("group_key") if group else F.lit("").alias("group_key"),
        F.lit(block).alias("block"),
        F.col(sub).cast("string").alias("sub_key") if sub else F.lit("").alias("sub_key"),
        F.col(item).cast("string").alias("item_key") if item else F.lit("").alias("item_key"),
        line.alias("line"),
    )


def _whole_number(value):
    """Shares as plain digits when they are whole."""
    return F.when(F.col(value) == F.floor(value), F.floor(value).cast("string")).otherwise(
        F.col(value).cast("string")
    )


def portfolio_lines(holdings: DataFrame) -> DataFrame:
    """Holdings as text: a heading and total per customer, a line per sector and position."""
    section = "1_holdings"
    known = holdings.withColumn("sector", F.coalesce("sector", F.lit("Unknown")))
    values = known.groupBy("customer_id", "sector").agg(
        F.sum(safe_float("current_value")).alias("sector_value"),
        F.min(full_name("first_name", "last_name")).alias("name"),
    )
    # One pass makes the lines of sectors and, at the first sector of a customer, heading and total.
    customer = Window.partitionBy("customer_id")
    by_sector = _shares(values).withColumns({
        "customer_name": F.min("name").over(customer), "place": F.row_number().over(customer.orderBy("sector")),
    })
    heading = F.concat(F.lit("## "), "customer_name", F.lit(" ("), F.col("customer_id"), F.lit(")"))
    total = F.concat(F.lit("Total portfolio value: "), money("total_value"))
    sector = F.concat(F.lit("  "), "sector", F.lit(" ("), percent("sector_pct"), F.lit(" of portfolio):"))

    def line(block: int, sub, text):
        return F.struct(F.lit(block).alias("block"), sub.alias("sub_key"), text.alias("line"))

    own = line(2, F.col("sector"), sector)
    first = F.array(line(0, F.lit(""), heading), line(1, F.lit(""), total), own)
    summary = by_sector.select("customer_id", F.explode(F.when(F.col("place") == 1, first).otherwise(F.array(own))).alias("l"))
    position = F.concat(
        F.lit("    "), "ticker", F.lit(" ("), "company_name", F.lit("): "),
        _whole_number("shares"), F.lit(" shares, "), money(safe_float("current_value")),
        F.lit(" value, "), percent(safe_float("percentage_of_portfolio")), F.lit(" of portfolio"),
    )
    summary = summary.select(
        F.lit(section).alias("section"), F.col("customer_id").cast("string").alias("group_key"), F.col("l.block").alias("block"),
        F.col("l.sub_key").alias("sub_key"), F.lit("").alias("item_key"), F.col("l.line").alias("line"),
    )
    return summary.unionByName(_lines(known, section, "customer_id", 2, "sector", "position_id", position))


def profile_lines(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Customers as text: heading, one detail line, and a line per account."""
    section = "2_profiles"
    present = F.concat_ws(
        " | ",
        F.when(is_populated("city") | is_populated("state"),
               F.concat(F.lit("Location: "), F.coalesce("city", F.lit("")), F.lit(", "), F.coalesce("state", F.lit("")))),
        F.when(F.col("annual_income").isNotNull(), F.concat(F.lit("Annual income: "), money("annual_income", 0))),
        F.when(F.col("credit_score").isNotNull(), F.concat(F.lit("Credit score: "), F.col("credit_score"))),
        F.when(F.col("date_of_birth").isNotNull(), F.concat(F.lit("Date of birth: "), F.col("date_of_birth"))),
        F.when(F.col("registration_date").isNotNull(), F.concat(F.lit("Member since: "), F.col("registration_date"))),
        F.when(is_populated("risk_profile"), F.concat(F.lit("Risk profile: "), "risk_profile")),
        F.when(is_populated("employment_status"), F.concat(F.lit("Employment: "), "employment_status")),
    )
    heading = F.concat(
        F.lit("## "), full_name("first_name", "last_name"), F.lit(" ("), F.col("customer_id"), F.lit(")")
    )
    counted = account_summary(customers, accounts).filter(F.col("account_count") > 0)
    owned = accounts.join(customers.select("customer_id"), "customer_id", "left_semi")
    account = F.concat(
        F.lit("    "), F.col("account_id"), F.lit(" ("), "account_type", F.lit("): "),
        money(safe_float("balance")), F.lit(", status="), F.col("status"),
    )
    parts = [
        _lines(customers, section, "customer_id", 0, None, None, heading),
        _lines(customers, section, "customer_id", 1, None, None, F.concat(F.lit("  "), present)),
        _lines(counted, section, "customer_id", 2, None, None,
               F.concat(F.lit("  Accounts ("), F.col("account_count"), F.lit("):"))),
        _lines(owned, section, "customer_id", 3, None, "account_id", account),
    ]
    return reduce(DataFrame.unionByName, parts)


def completeness_lines(customers: DataFrame) -> DataFrame:
    """Field coverage, attributes the schema lacks, and sample records as text."""
    section, spark = "3_completeness", customers.sparkSession
    covered = data_completeness(customers)
    total = customers.agg(F.count(F.lit(1)).alias("n"))
    missing = missing_fields(spark, customers.columns)
    sample = sample_customers(customers)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    parts = [
        _lines(total, section, None, 0, None, None, F.concat(F.lit("Total customers: "), F.col("n"))),
        _lines(covered, section, None, 1, "field", None,
               F.concat(F.lit("  "), "field", F.lit(": "), F.col("populated"), F.lit("/"), F.col("total_rows"),
                        F.lit(" populated ("), percent("pct", 0), F.lit(")"))),
        _lines(missing, section, None, 2, "field", None,
               F.concat(F.lit("  "), "field", F.lit(": "), "description", F.lit(" — NOT IN SCHEMA"))),
        _lines(sample, section, None, 3, "customer_id", None,
               F.concat(F.lit("  "), F.col("customer_id"), F.lit(" "), text("first_name"), F.lit(" "), text("last_name"),
                        F.lit(": email="), "has_email", F.lit(", phone="), "has_phone",
                        F.lit(", income="), text("annual_income"), F.lit(", credit_score="), text("credit_score"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def structured_lines(customers: DataFrame, accounts: DataFrame, holdings: DataFrame) -> DataFrame:
    """All three structured contexts, in section order."""
    return (
        portfolio_lines(holdings)
        .unionByName(profile_lines(customers, accounts))
        .unionByName(completeness_lines(customers))
    )
