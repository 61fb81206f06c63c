"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Sources share all words by weight; a target stops at ``most`` times its source's words and the
excess is shared again by weight (water filling, solved in closed form over the sorted caps).
Every document of a source gets the certain whole copies floor(target / words). The rest of the
target is a fixed-size sample without replacement: documents are ranked by their random odds
U / (1 - U) divided by their inclusion odds p / (1 - p), and taken in that order while their words
fit; documents of the boundary slice that are small enough then fill what is left. Where documents of
later slices still fit, they are taken in rank order, each if it fits what is left at its turn.

Defined results: a null text has size 0; a null source is a source of its own, ordered last; null
ids rank like the text "null"; rows repeated under one id are rows of their own, ordered by text. An empty table
gives an empty mix. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, forget

SLICE_DOCUMENTS = 1000  # documents ranked by one task, whatever the size of their source


def word_count(text: str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(identifier: str, seed: int) -> Column:
    """Repeatable number in (0, 1) of an id: the first 52 bits of its md5."""
    digest = F.md5(F.concat(F.coalesce(F.col(identifier).cast("string"), F.lit("null")), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sized: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, documents, source_size, target): one row for each source of ``sized`` (source, size)."""
    sources = sized.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("size").alias("source_size")
    )
    listed = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("weight", F.element_at(cycle, (listed % len(weights) + 1).cast("int")))
    by_cap = Window.orderBy(most * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    every = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.sum("source_size").over(by_cap.rowsBetween(Window.unboundedPreceding, -1))
    # Share of a unit of weight if exactly the sources with lower caps stop at theirs.
    level = (F.sum("source_size").over(every) - most * F.coalesce(before, F.lit(0))) / F.sum("weight").over(
        by_cap.rowsBetween(0, Window.unboundedFollowing)
    )
    levels = sources.withColumn("level", level).withColumn(
        "capped", most * F.col("source_size") < F.col("level") * F.col("weight")
    )
    final = F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(every)
    target = F.when(F.col("capped"), (most * F.col("source_size")).cast("double")).otherwise(F.col("weight") * final)
    return levels.select("source", "documents", "source_size", target.alias("target"))


def _later(placed: DataFrame, gaps: DataFrame) -> DataFrame:
    """(row, extra) of the documents after the boundary slices that fill ``gaps`` (of, part, gap), in rank order.

    A pass takes the documents that fit the gap, up to the first that goes beyond it, which is
    found by sums of slices and then in one slice of each source; the next pass starts after it.
    """
    ahead = placed.join(
        gaps, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") > F.col("part")) & (F.col("size") > 0) & (F.col("size") <= F.col("gap"))
    )
    place = F.struct("slice", "rank", "id", "size", "tie", "row")
    ahead = cut_lineage(ahead.select("source", "slice", "size", "row", place.alias("place"), "gap"))
    spent, taken = [ahead], ahead.select("row").limit(0)
    left = ahead.groupBy(F.col("source").alias("of")).agg(F.max("gap").alias("left"))
    left = cut_lineage(left.withColumn("after", F.lit(None).cast(ahead.schema["place"].dataType)))
    ahead = ahead.drop("gap")
    while not left.isEmpty():
        spent.append(left)
        fit = ahead.join(left, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") <= F.col("left")))
        fit = fit.where(F.col("after").isNull() | (F.col("place") > F.col("after"))).drop("of", "after")
        by_slice = Window.partitionBy("source").orderBy("slice")
        sums = fit.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("left").alias("room"))
        sums = sums.withColumn("before", F.sum("words").over(by_slice) - F.col("words")).where("before < room")
        sums = cut_lineage(sums.select(F.col("source").alias("of"), F.col("slice").alias("part"), "words", "before"))
        near = fit.join(sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("part"))).drop("of", "part")
        whole = F.col("before") + F.col("words") <= F.col("left")
        by_place = Window.partitionBy("source", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        edge = near.where(~whole).withColumn("fits", F.col("before") + F.sum("size").over(by_place) <= F.col("left"))
        found = cut_lineage(near.where(whole).withColumn("fits", F.lit(True)).unionByName(edge))
        spent += [sums, found]
        taken = taken.unionByName(found.where("fits").select("row"))
        # The blocked one, in the boundary slice, is the first there that does not fit; without one nothing is left to take.
        ends = found.groupBy(F.col("source").alias("of")).agg(
            (F.max("left") - F.sum(F.when(F.col("fits"), F.col("size")).otherwise(0))).alias("left"),
            F.min(F.when(~F.col("fits"), F.col("place"))).alias("after"),
        )
        left = cut_lineage(ends.where("left > 0 and after is not null"))
    spent.append(left)
    result = cut_lineage(taken.select("row", F.lit(1).cast("long").alias("extra")))
    for frame in spent:
        forget(frame)
    return result


def mix(
    docs: DataFrame, identifier: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (1, 2, 3), most: int = 3, preference: str | None = None, seed: int = 17,
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) for each document.

    ``preference`` names a positive column that scales a document's inclusion probability
    within its source (1 if null); without it all documents of a source are equally likely.
    """
    liking = F.coalesce(F.col(preference).cast("double"), F.lit(1.0)) if preference else F.lit(1.0)
    sized = cut_lineage(
        docs.select(
            F.col(identifier).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"),
            uniform(identifier, seed).alias("u"), liking.alias("liking"),
            F.xxhash64(F.col(text)).alias("tie"), F.monotonically_increasing_id().alias("row"),
        )
    )
    targets = source_targets(sized, weights, most).withColumn(
        "copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    )
    liked = sized.groupBy("source").agg(F.sum(F.col("liking") * F.col("size")).alias("liked"))
    targets = targets.join(liked, targets["source"].eqNullSafe(liked["source"])).drop(liked["source"])
    targets = targets.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size")).withColumn(
        "share", F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(F.lit(0.0))
    )
    docs_in = sized.join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    ).drop("of")
    chance = F.least(F.lit(1 - 1e-9), F.col("share") * F.col("liking") * F.col("source_size") / F.col("liked"))
    odds = F.col("u") / (1 - F.col("u"))
    docs_in = docs_in.withColumn("chance", F.when(F.col("share") > 0, chance).otherwise(F.lit(0.0))).withColumn(
        "rank", F.when(F.col("chance") > 0, odds / (F.col("chance") / (1 - F.col("chance"))))
    )
    # Scaled back by the odds of the source's mean share, ranks are about uniform: even slices.
    scaled = F.col("rank") * (F.col("share") / (1 - F.col("share")))
    slices = F.ceil(F.col("documents") / SLICE_DOCUMENTS)
    docs_in = docs_in.withColumn("slice", F.floor(slices * scaled / (1 + scaled)))

    sliced = docs_in.where(F.col("rank").isNotNull()).groupBy("source", "slice").agg(
        F.sum("size").alias("words"), F.first("rest").alias("rest")
    )
    running = Window.partitionBy("source").orderBy("slice")
    sliced = (
        sliced.withColumn("upto", F.sum("words").over(running))
        .withColumn("room", F.col("rest") - (F.col("upto") - F.col("words")))
        .select(F.col("source").alias("of"), F.col("slice").alias("part"), "words", "room")
    )
    placed = cut_lineage(docs_in.join(
        sliced, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("part")), "left"
    ).drop("of", "part"))
    at_edge = (F.col("room") > 0) & (F.col("room") < F.col("words"))
    clear = placed.where(~F.coalesce(at_edge, F.lit(False))).withColumn(
        "drawn", F.coalesce((F.col("room") >= F.col("words")).cast("long"), F.lit(0))
    )
    order = Window.partitionBy("source").orderBy("rank", "id", "size", "tie", "row").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("source")
    edge = (
        placed.where(at_edge)
        .withColumn("fits", F.sum("size").over(order) <= F.col("room"))
        .withColumn("gap", F.col("room") - F.sum(F.when(F.col("fits"), F.col("size")).otherwise(F.lit(0))).over(whole))
        .withColumn("small", ~F.col("fits") & (F.col("size") <= F.col("gap")))
        .withColumn("fill", F.sum(F.when(F.col("small"), F.col("size")).otherwise(F.lit(0))).over(order))
        .withColumn("drawn", (F.col("fits") | (F.col("small") & (F.col("fill") <= F.col("gap")))).cast("long"))
    )
    edge = cut_lineage(edge.select(*clear.columns))
    gaps = cut_lineage(edge.groupBy(F.col("source").alias("of"), F.col("slice").alias("part")).agg(
        (F.max("room") - F.sum(F.col("drawn") * F.col("size"))).alias("gap")
    ).where("gap > 0"))
    later = _later(placed, gaps)
    chosen = clear.unionByName(edge).join(later, "row", "left")
    copies = F.col("copies") + F.col("drawn") + F.coalesce("extra", F.lit(0))
    return chosen.select(
        F.col("id").alias(identifier), F.col("source").alias(source), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )
