"""Spelling variants by a bit-sliced position index: words one edit apart, found for a whole block of words at once.

An index holds, for each position and letter, the set of its words that have this letter there, one bit a word.
For a query, four sets run along its letters: words that agree so far, and words that have had one replaced,
one extra or one missing letter, the last two with their positions shifted by one. Each step is a few
operations on whole sets, whatever the number of words.

Two words one edit apart, the shorter of m letters, share their first m // 2 letters or their last m - m // 2,
so words meet in groups by m and either part. A group's words are its queries and its index; the index is
cut into blocks of ``BLOCK`` words and queries of a larger group go to each of its blocks, as rows of their own. A word
is numbered by falling count in its block, so the lowest bit of an answer is the best near word; tasks return counts
and best words, never pairs.

Defined results: null and empty texts hold no runs; a null id is hashed as an empty one; no words of the
asked length and count give no rows; rows repeated under one id count each; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, forget

LETTERS = r"[A-Za-zÀ-ÿ]+"
BLOCK = 2048  # words of one index
QUERIES = 8192  # queries of one call at most


class PositionIndex:
    """The words of a block, one bit each in the order given."""

    def __init__(self, words: list[str]):
        self.at: dict[tuple[int, str], int] = defaultdict(int)
        self.of_length: dict[int, int] = defaultdict(int)
        self.all = (1 << len(words)) - 1
        for bit, word in enumerate(words):
            mark = 1 << bit
            self.of_length[len(word)] |= mark
            for place, letter in enumerate(word):
                self.at[place, letter] |= mark

    def near(self, word: str, shared: int = 0) -> int:
        """Words exactly one edit from ``word``; of those that agree in the first ``shared`` letters, none."""
        get, zero, replaced, longer, shorter, known = self.at.get, self.all, 0, 0, 0, 0
        for i, letter in enumerate(word):
            here = get((i, letter), 0)
            shorter = shorter & get((i - 1, letter), 0) | zero
            longer = (longer | zero) & get((i + 1, letter), 0)
            replaced = replaced & here | zero & ~here
            zero &= here
            if i + 1 == shared:
                known = zero
            if not (zero or replaced or longer or shorter):
                return 0
        n, lengths = len(word), self.of_length.get
        found = replaced & lengths(n, 0) | (longer | zero) & lengths(n + 1, 0) | shorter & lengths(n - 1, 0)
        return found & ~known


def observed_words(docs: DataFrame, shortest: int, least: int, every: int, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the runs of letters with at least ``shortest`` letters and ``least`` occurrences.

    A run loses one letter where ``every`` divides the hash of its document and itself."""
    runs = docs.select(
        F.coalesce(F.col(identifier).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(f"({LETTERS})"), F.lit(1))).alias("raw"),
    ).select("id", F.translate("raw", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    mark = F.crc32(F.concat_ws(":", "id", "run"))
    place = (F.col("mark") % F.length("run")).cast("int")
    word = F.when(
        F.col("mark") % every == 0, F.concat(F.expr("substring(run, 1, place)"), F.expr("substring(run, place + 2)"))
    ).otherwise(F.col("run"))
    made = runs.withColumn("mark", mark).withColumn("place", place).select(word.alias("word"))
    return made.where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _grouped(words: DataFrame) -> DataFrame:
    """(group, m, word, n): each word in the groups by first and last part, as one of the shorter and of the longer length."""
    sized = words.withColumn("m", F.explode(F.array(F.length("word"), F.length("word") - 1)))
    half = F.expr("m div 2").cast("int")
    return sized.withColumn("half", half).select("word", "n", "m", F.explode(F.array(
        F.concat_ws(":", F.lit("p"), "m", F.expr("substring(word, 1, half)")),
        F.concat_ws(":", F.lit("s"), "m", F.expr("right(word, m - half)")),
    )).alias("group"))


def _answers(asked: DataFrame) -> DataFrame:
    """(word, near, top, form) of sorted rows (group, block, query, word, n): the near words of a query in one block, and the best of them."""

    def work(batches):
        key, names, index, out = None, [], None, []
        for batch in batches:
            for group, block, query, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (group, block) != key:
                    key, names, index = (group, block), [], None
                if not query:
                    names.append((-n, word))
                    continue
                if index is None:
                    names.sort()
                    index = PositionIndex([w for _, w in names])
                kind, m, _ = group.split(":", 2)
                found = index.near(word, int(m) // 2 if kind == "s" else 0)
                # Words of length m + 1 meet one another in the group of m + 1.
                if len(word) > int(m):
                    found &= index.of_length.get(int(m), 0)
                if found:
                    count, form = names[(found & -found).bit_length() - 1]
                    out.append((word, found.bit_count(), -count, form))
            if len(out) >= QUERIES:
                yield table(out)
                out = []
        if out:
            yield table(out)

    def table(rows):
        columns = list(zip(*rows))
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["word", "near", "top", "form"])

    return asked.mapInArrow(work, "word string, near long, top long, form string")


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, top, form): for words (word, n) with near ones, their number and the one of largest n, ties by letters."""
    grouped = _grouped(words)
    sizes = grouped.groupBy("group").agg(
        F.count(F.lit(1)).alias("size"), F.max(F.length("word") == F.col("m")).alias("whole")
    ).where("size > 1 and whole").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    held = cut_lineage(grouped.join(sizes.select("group", "blocks"), "group"))
    index = held.select("group", F.expr("cast(pmod(xxhash64(word), blocks) as int)").alias("block"), F.lit(False).alias("query"), "word", "n")
    query = held.select("group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("query"), "word", "n")
    parts = words.sparkSession.conf.get("spark.sql.shuffle.partitions")
    asked = index.unionByName(query).repartition(int(parts), "group", "block").sortWithinPartitions("group", "block", "query")
    best = F.min(F.struct((-F.col("top")).alias("top"), "form")).alias("best")
    found = cut_lineage(_answers(asked).groupBy("word").agg(F.sum("near").alias("n_near"), best))
    forget(held)
    result = found.select("word", "n_near", (-F.col("best.top")).alias("top"), "best.form")
    result.stored_at = found.stored_at
    return result


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form (word, form): every round doubles the steps taken; a form is rarer than nothing, so paths end."""
    state = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut_lineage(state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        forget(state)
        again = moved.where("moved").limit(1).count() > 0
        state = moved.select("word", "root")
        state.stored_at = moved.stored_at
        if not again:
            return state


def spelling_variants(
    docs: DataFrame, shortest: int = 6, least: int = 5, times: int = 5, every: int = 199,
    identifier: str = "doc_id", text: str = "text", block: int = BLOCK,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word: ``form`` is its near word of largest n if that is ``times`` its own."""
    words = cut_lineage(observed_words(docs, shortest, least, every, identifier, text))
    near = near_words(words, block)
    fits = F.col("top") >= times * F.col("n")
    formed = cut_lineage(
        words.join(near, "word", "left").select(
            "word", F.when(fits, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("top")).alias("form_n"),
        )
    )
    roots = _roots(formed.where("form is not null"))
    result = cut_lineage(
        formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )
    for frame in (words, near, formed, roots):
        forget(frame)
    return result
