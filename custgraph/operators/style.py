"""Investment style, sector rankings and representative customers and companies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import global_rank, rank_in_class, shuffle_key, top_per_key
from ..functions.text import is_populated

# How strongly a holding in a sector speaks for each style.
STYLE_SECTOR_SCORES = {
    "growth": {
        "Technology": 5.0, "Healthcare": 4.0, "Communication Services": 3.5, "Consumer Discretionary": 2.5,
    },
    "income": {
        "Utilities": 5.0, "Consumer Staples": 4.5, "Real Estate": 4.0, "Materials": 2.5, "Energy": 2.5,
    },
    "balanced": {
        "Financial Services": 4.0, "Industrials": 3.5, "Consumer Discretionary": 3.0, "Healthcare": 2.5,
    },
}
DEFAULT_SCORE = 1.0
STYLES = tuple(STYLE_SECTOR_SCORES)


def investment_style(
    customers: DataFrame, holdings: DataFrame, scores: Mapping[str, Mapping[str, float]] = STYLE_SECTOR_SCORES
) -> DataFrame:
    """The style with the highest score per customer, the first style winning a tie;
    customers without holdings go by income and credit score."""
    def weight(style: str):
        value = F.lit(DEFAULT_SCORE)
        for sector, score in scores[style].items():
            value = F.when(F.col("sector") == sector, score).otherwise(value)
        return value

    styles = tuple(scores)
    totals = holdings.groupBy("customer_id").agg(*[F.sum(weight(s)).alias(f"{s}_score") for s in styles])
    ranked = F.array_max(
        F.array(
            *[
                F.struct(F.col(f"{s}_score").alias("score"), F.lit(-i).alias("place"), F.lit(s).alias("style"))
                for i, s in enumerate(styles)
            ]
        )
    )
    fallback = (
        F.when((F.col("annual_income") > 100_000) & (F.col("credit_score") < 700), "growth")
        .when(F.col("credit_score") > 740, "income")
        .otherwise("balanced")
    )
    joined = customers.select("customer_id", "annual_income", "credit_score").join(totals, "customer_id", "left")
    return joined.select(
        "customer_id",
        F.when(F.col(f"{styles[0]}_score").isNotNull(), ranked["style"]).otherwise(fallback).alias("style"),
        *[F.coalesce(f"{s}_score", F.lit(0.0)).alias(f"{s}_score") for s in styles],
    )


def top_sectors(holdings: DataFrame, limit: int = 3) -> DataFrame:
    """The sectors a customer holds most positions in."""
    counts = (
        holdings.filter(is_populated("sector"))
        .groupBy("customer_id", "sector").agg(F.count(F.lit(1)).alias("positions"))
    )
    return top_per_key(counts, ["customer_id"], [F.desc("positions"), F.col("sector")], limit)


def sector_companies(companies: DataFrame, limit: int = 8) -> DataFrame:
    """Companies per sector and the names of the first few."""
    known = companies.withColumn("sector", F.coalesce("sector", F.lit("Unknown")))
    sizes = known.groupBy("sector").agg(F.count(F.lit(1)).alias("companies"))
    first = top_per_key(known, ["sector"], [F.col("company_id")], limit)
    listed = first.groupBy("sector").agg(
        F.array_sort(F.collect_list(F.struct("rank", "name", "ticker_symbol"))).alias("_first")
    )
    return sizes.join(listed, "sector").select(
        "sector", "companies",
        F.array_join(F.col("_first.name"), ", ").alias("names"),
        F.array_join(F.col("_first.ticker_symbol"), ", ").alias("tickers"),
    )


def representative_customers(customers: DataFrame, count: int, seed: int = 42, label: str = "risk_profile") -> DataFrame:
    """``count`` customers: one per class, then an even stride through the income order of the
    other labeled ones, then unlabeled ones. ``place`` orders the three sources."""
    labeled = customers.filter(is_populated(label))
    unlabeled = customers.filter(~F.coalesce(is_populated(label), F.lit(False)))
    key = shuffle_key(seed, "customer_id")
    first = top_per_key(labeled, [label], [key, F.col("customer_id")], 1, "_r").select(
        "customer_id", label, F.lit("class").alias("source"), F.lit(1).alias("place"), F.col(label).alias("_sort")
    ).orderBy("_sort").limit(count)
    taken = first.count()
    rest = labeled.join(first.select("customer_id"), "customer_id", "left_anti")
    strided = None
    if taken < count:
        ranked = global_rank(
            rest.select("customer_id", label, "annual_income"),
            F.col("annual_income").asc_nulls_first(), "customer_id",
        )
        step = max(1, rest.count() // (count - taken))
        strided = (
            ranked.filter((F.col("rank") - 1) % step == 0)
            .filter(F.col("rank") <= step * (count - taken))
            .select("customer_id", label, F.lit("income").alias("source"), F.lit(2).alias("place"),
                    F.lpad(F.col("rank").cast("string"), 20, "0").alias("_sort"))
        )
    fill = unlabeled.select(
        "customer_id", label, F.lit("unlabeled").alias("source"), F.lit(3).alias("place"), key.alias("_sort")
    ).orderBy("_sort", "customer_id").limit(count)
    chosen = first.unionByName(fill) if strided is None else first.unionByName(strided).unionByName(fill)
    return chosen.orderBy("place", "_sort", "customer_id").limit(count).drop("_sort")


def representative_companies(companies: DataFrame, count: int, seed: int = 42) -> DataFrame:
    """``count`` companies: one per sector, then others in shuffled order."""
    known = companies.withColumn("sector", F.coalesce("sector", F.lit("Unknown")))
    ranked = rank_in_class(known, ["sector"], "company_id", seed)
    place = F.when(F.col("class_rank") == 1, 1).otherwise(2)
    key = shuffle_key(seed, "company_id")
    return (
        ranked.select("company_id", "name", "sector", place.alias("place"), key.alias("_sort"))
        .orderBy("place", "_sort", "company_id").limit(count).drop("_sort")
    )


def shuffled_first(df: DataFrame, identifier: str, count: int, seed: int = 42) -> DataFrame:
    """``count`` rows in shuffled order, as the banks to describe are picked."""
    return df.orderBy(shuffle_key(seed, identifier), identifier).limit(count)
