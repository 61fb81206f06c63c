"""Bounded samples of labelled rows and linear models over hashed n-gram indicators.

Features are 64-bit hashes, distinct for each text. A model keeps the sorted hashes of the features
it knows and a weight for each; all others weigh nothing, so its size is bounded by the sample.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import byte_texts

SAMPLE = 4000  # labelled rows a model is fitted on, at most


def held_out(identifier: str, modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(identifier).cast("string"), F.lit(""))) % modulus == remainder


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, features: Callable[[bytes], np.ndarray],
    identifier: str = "doc_id", text: str = "text", sample: int = SAMPLE,
) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and labels of at most ``sample`` rows outside the held-out fifth, chosen by md5 of the id.

    Half of the bound goes to each class. Rows with a null label or id teach nothing, and of rows
    with one id and several labels each pair is a row.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(identifier).isNotNull() & ~held_out(identifier, 5, 0))
    known = known.select(F.col(identifier).alias("_id"), F.col(label).cast("int").alias("_label"))
    rank = F.md5(F.col("_id").cast("string"))
    chosen = known.where("_label = 0").orderBy(rank).limit(sample // 2).unionByName(
        known.where("_label = 1").orderBy(rank).limit(sample // 2)
    )
    texts = docs.select(F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    joined = texts.join(F.broadcast(chosen), "_id").select("_label", "_text", rank.alias("_rank"))

    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([features(x).tobytes() for x in byte_texts(batch.column(1))], pa.binary())],
                names=["label", "rank", "features"],
            )

    rows = joined.mapInArrow(work, "label int, rank string, features binary").orderBy("rank", "label", "features").limit(2 * sample).collect()
    return [np.frombuffer(bytes(r["features"]), np.uint64) for r in rows], np.array([r["label"] for r in rows], np.int64)


@dataclass
class Design:
    """Sparse 0/1 matrix in rows: feature numbers of all rows after one another, and their bounds."""

    known: np.ndarray
    columns: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray], least: int) -> Design:
        """Of features that occur in at least ``least`` rows."""
        every = np.concatenate([np.empty(0, np.uint64), *rows])
        known, counts = np.unique(every, return_counts=True)
        known = known[counts >= least]
        picked = [lookup(known, r) for r in rows]
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in picked])]).astype(np.int64)
        return cls(known, np.concatenate([np.empty(0, np.int64), *picked]), bounds)

    def reduced(self, kept: np.ndarray) -> Design:
        """The design of the features marked in ``kept``."""
        place, held = np.cumsum(kept) - 1, kept[self.columns]
        bounds = np.concatenate([[0], np.cumsum(held)])[self.bounds]
        return Design(self.known[kept], place[self.columns[held]], bounds)

    @property
    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def lookup(known: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Numbers in ``known`` (sorted) of those features that are in it."""
    if not len(known) or not len(features):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(known, features), len(known) - 1)
    return at[known[at] == features]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    """Steps of a parameter vector along its gradients, each scaled by the gradient's past size."""

    def __init__(self, size: int, rate: float):
        self.rate, self.mean, self.square, self.step = rate, np.zeros(size), np.zeros(size), 0

    def __call__(self, gradient: np.ndarray) -> np.ndarray:
        self.step += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.999 * self.square + 0.001 * gradient**2
        mean, square = self.mean / (1 - 0.9**self.step), self.square / (1 - 0.999**self.step)
        return self.rate * mean / (np.sqrt(square) + 1e-9)
