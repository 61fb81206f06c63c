"""Benchmark decontamination: CGK embedding, bit sampling over item-sized windows, exact edit check.

Texts are words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lowered. A document is contaminated by an
item of n words if some run of its words is within floor(n * ``share``) word edits of the item.

A match with k edits leaves at least floor((n - k) / (k + 1)) neighboring words of the item as they
are, so windows of the item's size are laid only where so many of its words stand, which loses no
match. The random walk of Chakraborty, Goldenberg and Koucky turns a window into 3n symbols such
that few edits give few differences; in each of ``WALKS`` walks, ``TABLES`` tables compare ``BITS``
sampled symbols. Windows that agree with the item in a table are verified by edit distance against
the words around them.

The items are a query set, taken in blocks of about ``ITEMS``; each block is sent to all tasks.

Defined results: null and empty texts are clean; items without words match nothing; rows repeated
under one id share a verdict; texts are read whole; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .minhash import row_key
from .words import ALNUM, byte_texts, chunks, hash_texts, hash_words, mix

WALKS, TABLES, BITS = 8, 8, 2
ITEMS = 5000
SHARE = 0.2
SLICE = 4096  # windows embedded at once
CHUNK = 16 << 20  # bytes of texts handled at once; a longer text makes a chunk of its own


def edits_allowed(n: int, share: float) -> int:
    return int(n * share + 1e-9)


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the run of ``size`` words from each word on."""
    if len(words) < size:
        return words[:0]
    total = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - size + 1 + i], 6)
    return total


def embed(windows: np.ndarray, walk: int, steps: np.ndarray) -> np.ndarray:
    """Symbols that the random walk of number ``walk`` reads from each row at the given sorted steps."""
    count, n = windows.shape
    padded = np.hstack([windows, np.zeros((count, 1), np.uint64)])
    at, rows, out, wanted = np.zeros(count, np.int64), np.arange(count), np.zeros((count, len(steps)), np.uint64), 0
    for step in range(int(steps[-1]) + 1):
        symbol = padded[rows, at]
        while wanted < len(steps) and steps[wanted] == step:
            out[:, wanted] = symbol
            wanted += 1
        at = np.minimum(at + (mix(symbol, 1000 + walk * 100_003 + step) >> np.uint64(63)).astype(np.int64), n)
    return out


def sampled(n: int, walk: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted steps of all tables of a walk over n words, and where each table's steps are in them."""
    steps = np.random.default_rng([n, walk]).integers(0, max(1, 2 * n), TABLES * BITS)
    order = np.argsort(steps, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return steps[order], place.reshape(TABLES, BITS)


def distance(item: np.ndarray, words: np.ndarray) -> int:
    """Least number of word edits between the item and any run of ``words``."""
    steps = np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, np.int64)
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (words != word), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


class Items:
    """Items as word hashes, with the runs that must stand unchanged somewhere in a match."""

    def __init__(self, rows: list[tuple[int, str]], share: float = SHARE):
        self.share = share
        self.items = [(i, w) for i, w in ((i, hash_words((t or "").encode().lower(), ALNUM)[1]) for i, t in rows) if len(w)]

    @cached_property
    def runs(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each run length: sorted hashes, and the item and offset of each."""
        found = defaultdict(lambda: ([], [], []))
        for number, (_, words) in enumerate(self.items):
            n = len(words)
            k = edits_allowed(n, self.share)
            size = max(1, (n - k) // (k + 1))
            hashes = grams(words, size)
            for held, new in zip(found[size], (hashes, np.full(len(hashes), number), np.arange(len(hashes)))):
                held.append(new)
        out = {}
        for size, held in found.items():
            hashes, number, offset = map(np.concatenate, held)
            order = np.argsort(hashes, kind="stable")
            out[size] = hashes[order], number[order], offset[order]
        return out

    @cached_property
    def keys(self) -> dict[int, list[np.ndarray]]:
        """Sampled symbols of every item, by walk."""
        return {}

    def item_symbols(self, number: int, walk: int, steps: np.ndarray) -> np.ndarray:
        held = self.keys.setdefault(number, [None] * WALKS)
        if held[walk] is None:
            held[walk] = embed(self.items[number][1][None, :], walk, steps)[0]
        return held[walk]

    def windows(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct (text, item, start) of the windows to look at in texts that lie between ``bounds``;
        a start may lie before the first word of its text."""
        found = [np.empty((0, 3), np.int64)]
        for size, (hashes, number, offset) in self.runs.items():
            here = grams(words, size)
            low = np.searchsorted(hashes, here)
            hit = np.flatnonzero(hashes[np.minimum(low, len(hashes) - 1)] == here)
            text = np.searchsorted(bounds, hit, side="right") - 1
            whole = hit + size <= bounds[text + 1]  # not across the end of a text
            hit, text = hit[whole], text[whole]
            low, high = low[hit], np.searchsorted(hashes, here[hit], side="right")
            times = high - low
            which = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
            new = np.stack([np.repeat(text, times), number[which], np.repeat(hit, times) - offset[which]], axis=1)
            found.append(np.unique(new, axis=0))
        return np.concatenate(found)

    def similar(self, words: np.ndarray, bounds: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Which windows agree with their item in a table."""
        agree = np.zeros(len(windows), bool)
        sizes = np.array([len(w) for _, w in self.items], np.int64)[windows[:, 1]]
        for n in np.unique(sizes).tolist():
            of_size = np.flatnonzero(sizes == n)
            for at in range(0, len(of_size), SLICE):
                some = of_size[at : at + SLICE]
                text, number, start = windows[some].T
                place = start[:, None] + np.arange(n)
                outside = (place < bounds[text][:, None]) | (place >= bounds[text + 1][:, None])
                cut = np.where(outside, np.uint64(0), words[np.clip(place, 0, len(words) - 1)])
                numbers, back = np.unique(number, return_inverse=True)
                for walk in range(WALKS):
                    steps, tables = sampled(n, walk)
                    goal = np.stack([self.item_symbols(int(x), walk, steps) for x in numbers])[back]
                    agree[some] |= (embed(cut, walk, steps) == goal)[:, tables].all(axis=2).any(axis=1)
        return agree

    def matches(self, words: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], int]:
        """Least number of edits by (text, item id), where an item contaminates a text."""
        best: dict[tuple[int, int], int] = {}
        windows = self.windows(words, bounds)
        if not len(windows):
            return best
        for text, number, start in windows[self.similar(words, bounds, windows)].tolist():
            name, item = self.items[number]
            k = edits_allowed(len(item), self.share)
            if best.get((text, name)) == 0:
                continue
            edits = distance(item, words[max(bounds[text], start - k) : min(bounds[text + 1], start + len(item) + k)])
            if edits <= k:
                best[text, name] = min(best.get((text, name), edits), edits)
        return best


def _hits(docs: DataFrame, items: Items) -> DataFrame:
    kind = docs.schema["id"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            texts, rows, found = byte_texts(batch.column(1)), [], []
            for a, b in chunks(texts, CHUNK):
                words, bounds = hash_texts(texts[a:b], ALNUM)
                for (text, name), edits in items.matches(words, bounds).items():
                    rows.append(a + text)
                    found.append((name, edits))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32())],
                names=["id", "item", "edits"],
            )

    return docs.mapInArrow(work, f"id {kind}, item long, edits int")


def hits(
    docs: DataFrame, benchmark: DataFrame, identifier: str = "doc_id", text: str = "text",
    item: str = "item_id", share: float = SHARE, items_at_once: int = ITEMS,
) -> DataFrame:
    """(id, item, edits) of every contaminated document and item; a stored table."""
    docs = docs.select(F.col(identifier).alias("id"), F.col(text).alias("text"))
    asked = benchmark.select(F.col(item).cast("long"), F.col("text")).where(F.col(item).isNotNull())
    blocks = -(-asked.count() // items_at_once)
    found = _hits(docs.limit(0), Items([], share))
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64(item), F.lit(blocks)) == block).collect()
        found = found.unionByName(_hits(docs, Items([tuple(r) for r in rows], share)))
    return cut_lineage(found.groupBy("id", "item").agg(F.min("edits").alias("edits")))


def verdicts(docs: DataFrame, benchmark: DataFrame, identifier: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(id, contaminated, n_items, nearest_item, edits) of every document; the nearest item is the least of those with fewest edits."""
    found = hits(docs, benchmark, identifier, text, **options)
    fewest = found.groupBy(F.col("id").alias("of")).agg(F.count(F.lit(1)).alias("n_items"), F.min("edits").alias("fewest"))
    nearest = (
        found.join(fewest, F.col("id").eqNullSafe(F.col("of")) & (F.col("edits") == F.col("fewest")))
        .groupBy("of").agg(F.first("n_items").alias("n_items"), F.min("item").alias("nearest_item"), F.first("fewest").alias("edits"))
    )
    return docs.select(identifier).join(nearest, F.col(identifier).eqNullSafe(F.col("of")), "left").select(
        identifier, F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"), "nearest_item", "edits",
    )


def clean(docs: DataFrame, benchmark: DataFrame, identifier: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, all columns kept; decided by row, whatever other rows share its id."""
    keyed = docs.withColumn("_row", row_key(identifier, text))
    found = hits(keyed, benchmark, "_row", text, **options).select(F.col("id").alias("_gone")).distinct()
    return keyed.join(found, F.col("_row").eqNullSafe(F.col("_gone")), "left_anti").drop("_row")
