"""Joins and ranks that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SLICE_ROWS = 1_000_000  # rows of one key that a single task takes without trouble
DEAL_ROWS = 1 << 18  # rows of distinct keys that a single task holds at once


def deal(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by ``keys`` into tasks of ``DEAL_ROWS``; few rows stay as they are.

    For keys that hardly repeat: groups of them are then held once, by a task whose size does not grow with the table.
    """
    parts = -(-rows // DEAL_ROWS)
    return df.repartition(parts, *keys) if parts > 1 else df


def hot_keys(df: DataFrame, key: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(key, fan): every key with more than ``slice_rows`` rows and the slices it needs.

    There are fewer than rows / ``slice_rows`` such keys, a millionth of the table by default,
    hence safe to broadcast. Lazy, so the slicing adapts to the data.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > slice_rows)
    return counts.select(key, F.ceil(F.col("_rows") / slice_rows).cast("int").alias("fan"))


def slice_rows(big: DataFrame, key: str, hot: DataFrame, spread_by: Sequence[str]) -> DataFrame:
    """``big`` with a ``salt`` that cuts the rows of a hot key into slices."""
    sliced = F.pmod(F.xxhash64(*spread_by), F.col("fan")).cast("int")
    return (
        big.join(F.broadcast(hot), key, "left")
        .withColumn("salt", F.coalesce(sliced, F.lit(0)))
        .drop("fan")
    )


def copy_rows(small: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``small`` with one copy per slice of its key, to meet :func:`slice_rows`."""
    slices = F.sequence(F.lit(0), F.coalesce(F.col("fan"), F.lit(1)) - 1)
    return (
        small.join(F.broadcast(hot), key, "left").withColumn("salt", F.explode(slices)).drop("fan")
    )


def salted_join(
    big: DataFrame, small: DataFrame, key: str, spread_by: Sequence[str], how: str = "inner",
    per_slice: int = SLICE_ROWS, measure: DataFrame | None = None,
) -> DataFrame:
    """``big`` joined to ``small`` on ``key``, the rows of hot keys spread over many tasks.

    Keys are counted on ``measure``, a stored or cached frame that ``big`` comes from, so
    that only its key column is read once more. It defaults to ``big`` itself.
    """
    hot = hot_keys(big if measure is None else measure, key, per_slice)
    left, right = slice_rows(big, key, hot, spread_by), copy_rows(small, key, hot)
    return left.join(right, [key, "salt"], how).drop("salt")


def shuffle_key(seed: int, identifier: str) -> Column:
    """Repeatable pseudo-random sort key of a row."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(identifier).cast("string")))


def rank_in_class(df: DataFrame, classes: Sequence[str], identifier: str, seed: int) -> DataFrame:
    """Adds ``class_rank`` (1-based, in ``shuffle_key`` order) and ``class_size``.

    A class is ranked in 4,096 slices of the key range, each slice offset by the
    sizes of the slices before it, so no task sees a whole class.
    """
    keyed = df.withColumn("_key", shuffle_key(seed, identifier)).withColumn(
        "_slice", F.substring("_key", 1, 3)
    )
    sizes = keyed.groupBy(*classes, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    by_class = Window.partitionBy(*classes)
    offsets = sizes.select(
        *classes,
        "_slice",
        (F.sum("_n").over(by_class.orderBy("_slice")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(by_class).alias("class_size"),
    )
    in_slice = F.row_number().over(
        Window.partitionBy(*classes, "_slice").orderBy("_key", identifier)
    )
    return (
        keyed.withColumn("_local", in_slice)
        .join(offsets, [*classes, "_slice"])
        .withColumn("class_rank", F.col("_before") + F.col("_local"))
        .drop("_key", "_slice", "_local", "_before")
    )


def global_rank(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """Adds the 1-based position of each row in the total order ``order``.

    A range-partitioned sort numbers the rows inside each partition; the
    partition sizes (one row per partition) give the offsets.
    """
    numbered = cut_lineage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("_part", F.shiftright("_at", 33))
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before")
    )
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + local + 1)
        .drop("_at", "_part", "_before")
    )


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int, name: str = "rank") -> DataFrame:
    """The first ``limit`` rows of each key; each map task forwards at most ``limit`` rows per key."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, position).filter(F.col(name) <= limit)
