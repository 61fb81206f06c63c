"""Collocations by prefix-free parsing: phrases are counted inside the distinct chunks of the texts.

A word whose hash is divisible by ``PERIOD`` triggers a new chunk, so equal passages are cut alike wherever
they stand. A chunk runs from its trigger to the next one and on over the first ``LONGEST - 1`` words behind it;
a phrase belongs to the chunk in whose own words it starts, so the overlap is counted once. Equal chunks of a
language are one row of the dictionary with a frequency, and every count is a sum of these frequencies.

Phrases are counted by length. A phrase reaches ``least`` only if both phrases within it that are one word
shorter do, so each pass asks a filter of the frequent phrases of the pass before. The filter has at most
``FILTER_BITS`` bits whatever the corpus; false hits cost rows, never results. Phrases are 64-bit hashes with
the language mixed in until the frequent ones are known; a last pass brings their words. What follows are joins.

Defined results: null and empty texts hold no words; a null language is ``und``; no candidates give no rows;
rows repeated under one id count each; other columns are not read. Words of two languages never meet.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, forget
from .words import byte_texts, chunks, hash_words, mix

LONGEST = 4  # words of a phrase at most
PERIOD = 24  # one word in so many starts a chunk
FILTER_BITS = 1 << 27  # of the filter that every task gets: 16 MB
BITS_PER_PHRASE = 16
HELD = 4 << 20  # phrases a task adds up before it hands them on

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_GAPS = b" \t" + _BREAKS
_BREAK, WORD = np.zeros(256, bool), np.ones(256, bool)
_BREAK[list(_BREAKS)] = True
WORD[list(_GAPS)] = False
_WORD = re.compile(b"[^" + re.escape(_GAPS) + b"]+")
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def dictionary(docs: DataFrame, period: int = PERIOD) -> DataFrame:
    """(lang, core, chunk, times): the distinct chunks of documents (lang, text); ``core`` words are the chunk's own."""

    def work(batches):
        for batch in batches:
            texts = byte_texts(batch.column(1))
            for a, b in chunks(texts):
                data = b"\n".join(texts[a:b]).lower()
                starts, hashes = hash_words(data, WORD)
                ends = np.cumsum([len(x) + 1 for x in texts[a:b]])
                bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
                opens = mix(hashes, 11) % np.uint64(period) == 0
                opens[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
                first = np.flatnonzero(opens)
                doc = np.searchsorted(bounds, first, side="right") - 1
                core = np.minimum(np.append(first[1:], len(starts)), bounds[doc + 1]) - first
                stop = np.minimum(first + core + LONGEST - 1, bounds[doc + 1])
                until = np.where(stop < bounds[doc + 1], np.append(starts, len(data))[stop], ends[doc] - 1)
                made = [data[x:y].rstrip(_GAPS) for x, y in zip(starts[first].tolist(), until.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc + a)), pa.array(core.astype(np.int32)), pa.array(made, pa.binary())],
                    names=["lang", "core", "chunk"],
                )

    made = docs.mapInArrow(work, "lang string, core int, chunk binary")
    return made.groupBy("lang", "core", "chunk").agg(F.count(F.lit(1)).alias("times"))


def _name(lang: str) -> np.uint64:
    return hash_words(b"\n" + lang.encode(), np.arange(256) != 0x0A)[1][0] if lang else np.uint64(1)


def _phrases(batch: pa.RecordBatch):
    """(text, starts, row of each word, keys of the phrases of 1 to LONGEST words at each word, own words): a batch of chunks.

    Keys are None beyond the end of a piece or of a chunk; ``good[k]`` tells where."""
    texts = batch.column(2).to_pylist()
    data = b"\n".join(texts)
    starts, hashes = hash_words(data, WORD)
    ends = np.cumsum([len(x) + 1 for x in texts])
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)]).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    own = np.arange(len(starts)) - bounds[row] < batch.column(1).to_numpy()[row]
    cut = np.cumsum(_BREAK[np.frombuffer(data, np.uint8)], dtype=np.int64)[starts]
    names = {x: _name(x) for x in set(batch.column(0).to_pylist())}
    lang = np.array([names[x] for x in batch.column(0).to_pylist()], np.uint64)[row]
    keys, good, whole = [], [], np.zeros(len(starts), np.uint64)
    for k in range(LONGEST):
        fits = np.zeros(len(starts), bool)
        n = max(0, len(starts) - k)
        fits[:n] = cut[k:] == cut[:n]  # rows are joined by a break
        whole[:n] = mix(whole[:n] * _PRIME + hashes[k:], 12)
        keys.append(mix(whole ^ lang, 13))
        good.append(fits)
    return data, starts, row, keys, good, own


class Filter:
    """Two bits for each key in a table of bounded size."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(64 * len(words) - 1)

    @classmethod
    def of(cls, keys: DataFrame, most: int = FILTER_BITS) -> Filter:
        n = keys.count()
        size = 64
        while size < min(most, BITS_PER_PHRASE * n):
            size *= 2
        places = keys.select(F.explode(F.array(
            F.col("key").bitwiseAND(size - 1), F.shiftrightunsigned("key", 32).bitwiseAND(size - 1)
        )).alias("place"))
        rows = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
        ).toArrow()  # at most ``size`` / 64 rows
        words = np.zeros(size // 64, np.uint64)
        words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
        return cls(words)

    def __contains__(self, key: int) -> bool:
        return bool(self.has(np.array([key], np.uint64))[0])

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for place in (keys & self.mask, (keys >> np.uint64(32)) & self.mask):
            found &= (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def _counts(parsed: DataFrame, k: int, shorter, held: int = HELD) -> DataFrame:
    """(key, f) of the phrases of ``k`` words whose parts of ``k - 1`` words pass the filter (a broadcast, None for words)."""

    def work(batches):
        keys, times, size = [], [], 0

        def summed():
            name, at = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros(len(name), np.int64)
            np.add.at(total, at, np.concatenate(times))
            return pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(total)], names=["key", "f"])

        for batch in batches:
            if not batch.num_rows:
                continue
            _, starts, row, name, good, own = _phrases(batch)
            take = good[k - 1] & own
            if shorter is not None:
                known = good[k - 2].copy()
                known[known] = shorter.value.has(name[k - 2][known])
                take[:-1] &= known[:-1] & known[1:]
            at = np.flatnonzero(take)
            keys.append(name[k - 1][at])
            times.append(batch.column(3).to_numpy()[row[at]])
            size += len(at)
            if size >= held:
                yield summed()
                keys, times, size = [], [], 0
        if size:
            yield summed()

    return parsed.mapInArrow(work, "key long, f long").groupBy("key").agg(F.sum("f").alias("f"))


def _texts(parsed: DataFrame, filters) -> DataFrame:
    """(key, lang, k, phrase) of phrases that pass the filter of their length, some more than once."""

    def work(batches):
        told = [np.empty(0, np.uint64)] * LONGEST
        for batch in batches:
            if not batch.num_rows:
                continue
            data, starts, row, keys, good, own = _phrases(batch)
            langs = batch.column(0).to_pylist()
            for k in range(LONGEST):
                at = np.flatnonzero(good[k] & own)
                at = at[filters.value[k].has(keys[k][at])]
                name, where = np.unique(keys[k][at], return_index=True)
                new = ~np.isin(name, told[k], assume_unique=True)
                name, at = name[new], at[where[new]]
                told[k] = np.concatenate([told[k], name])
                if len(told[k]) > HELD:
                    told[k] = name
                words = [[_WORD.match(data, starts[i + j]).group() for j in range(k + 1)] for i in at.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), pa.array([langs[i] for i in row[at].tolist()], pa.string()),
                     pa.array(np.full(len(at), k + 1, np.int32)), pa.array([b" ".join(w) for w in words], pa.binary()).cast(pa.string())],
                    names=["key", "lang", "k", "phrase"],
                )

    return parsed.mapInArrow(work, "key long, lang string, k int, phrase string")


def frequent_phrases(parsed: DataFrame, least: int, most_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, phrase, k, f) of all phrases of 1 to LONGEST words that occur ``least`` times or more, from a stored dictionary."""
    context = parsed.sparkSession.sparkContext
    known, filters, shorter = [], [], None
    for k in range(1, LONGEST + 1):
        known.append(cut_lineage(_counts(parsed, k, shorter).where(F.col("f") >= least)))
        filters.append(Filter.of(known[-1], most_bits))
        shorter = context.broadcast(filters[-1])
    counted = known[0].withColumn("of", F.lit(1))
    for k, frame in enumerate(known[1:], 2):
        counted = counted.unionByName(frame.withColumn("of", F.lit(k)))
    named = _texts(parsed, context.broadcast(filters)).dropDuplicates(["key", "k"])
    found = cut_lineage(
        named.join(counted.withColumnRenamed("key", "own"), (F.col("key") == F.col("own")) & (F.col("k") == F.col("of")))
        .select("lang", "phrase", "k", "f")
    )
    for frame in known:
        forget(frame)
    return found


def collocations(
    docs: DataFrame, least: int = 30, covered: int = 80, best: int = 2000, lang: str = "lang", text: str = "text",
    period: int = PERIOD, most_bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of each language by score, count and phrase.

    A phrase of 2 to LONGEST words that occurs a >= ``least`` times is cut where floor(2000000 a / (l + r)) is lowest,
    l and r being the counts of the two parts. One within a longer candidate of ``covered`` percent of its count goes."""
    read = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    parsed = cut_lineage(dictionary(read, period))
    found = frequent_phrases(parsed, least, most_bits)
    totals = parsed.groupBy("lang").agg(F.sum(F.col("core") * F.col("times")).alias("n"))
    words = F.split("phrase", " ")
    part = lambda name, at: F.array_join(F.slice(words, at, F.col(name)), " ")
    long = found.where("k > 1").withColumnRenamed("f", "a")
    cuts = (
        long.select("lang", "phrase", "a", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
        .withColumn("rest", F.col("k") - F.col("cut"))
        .select("lang", "phrase", "a", "cut", part("cut", F.lit(1)).alias("left"), part("rest", F.col("cut") + 1).alias("right"))
    )
    count = lambda of, name: found.select("lang", F.col("phrase").alias(of), F.col("f").alias(name))
    scored = (
        cuts.join(count("left", "l"), ["lang", "left"]).join(count("right", "r"), ["lang", "right"])
        .withColumn("score", F.expr("cast(a as decimal(19, 0)) * 2000000 div (cast(l as decimal(19, 0)) + r)"))
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("least"))
    )
    inner = (
        long.where("k > 2").select("lang", "phrase", "a", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
        .select("lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
        .select("lang", part("size", F.col("at")).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    stay = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(19, 0)") * 100 < F.col("a").cast("decimal(19, 0)") * covered)
    )
    order = Window.partitionBy("lang").orderBy(F.col("least.score").desc(), F.col("a").desc(), F.col("phrase"))
    result = cut_lineage(
        stay.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
        .join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "least.l", "least.r", "n", "least.score")
    )
    for frame in (parsed, found):
        forget(frame)
    return result
