"""Quality by naive Bayes support vectors: n-gram indicators scaled by class log-count ratios, then a
linear hinge-loss model by dual coordinate descent.

N-grams are words ``[^\\x20\\x09-\\x0D]+``, pairs of neighboring words, and runs of three bytes, of the
text with A-Z lowered. Margins become probabilities by a logistic curve fitted on the sample. The
model is fitted on at most ``learn.SAMPLE`` labelled rows outside the held-out fifth; labels,
language, source and id are no inputs; every text is scored whole.

Defined results: a null or empty text is scored by the intercept; without labels of both classes
every score is 0.5; repeated rows give one row each; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learn import SAMPLE, Adam, Design, held_out, labelled_sample, lookup, sigmoid
from .words import byte_texts, hash_words, mix

THRESHOLD = 0.3


def features(text: bytes) -> np.ndarray:
    """Hashes of the distinct n-grams of a text."""
    data = text.lower()
    words = hash_words(data)[1]
    pairs = mix(words[:-1] * np.uint64(3) + words[1:], 2)
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    runs = np.unique((raw[:-2] << np.uint64(16)) | (raw[1:-1] << np.uint64(8)) | raw[2:]) if len(raw) > 2 else raw[:0]
    return np.unique(np.concatenate([words, pairs, mix(runs, 3)]))


@dataclass
class Model:
    known: np.ndarray
    weights: np.ndarray
    intercept: float
    slope: float
    shift: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            at = lookup(self.known, features(text))
            out[i] = self.weights[at].sum() / np.sqrt(max(1, len(at))) + self.intercept
        return sigmoid(self.slope * out + self.shift)


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, rounds: int = 15, seed: int = 5) -> Model:
    """The model of feature rows and 0/1 labels; a row's indicators are scaled to length 1 before the ratios."""
    if len(set(labels.tolist())) < 2:
        return Model(np.empty(0, np.uint64), np.empty(0), 0.0, 0.0, 0.0)
    design = Design.of(rows, least=3)
    size, n, row_of = len(design.known), len(rows), design.row_of
    good = labels[row_of] == 1
    p = np.bincount(design.columns[good], minlength=size) + 1.0
    q = np.bincount(design.columns[~good], minlength=size) + 1.0
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    sign = np.where(labels == 1, 1.0, -1.0)
    bounds, w, b = design.bounds, np.zeros(size), 0.0
    scale = [1 / np.sqrt(max(1, bounds[i + 1] - bounds[i])) for i in range(n)]
    values = [ratio[design.columns[bounds[i] : bounds[i + 1]]] * scale[i] for i in range(n)]
    norm, alpha, dice = np.array([v @ v + 1.0 for v in values]), np.zeros(n), np.random.default_rng(seed)
    for _ in range(rounds):
        for i in dice.permutation(n):
            at = design.columns[bounds[i] : bounds[i + 1]]
            gradient = sign[i] * (w[at] @ values[i] + b) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost)
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * sign[i] * values[i]
                b += (new - alpha[i]) * sign[i]
                alpha[i] = new
    margin = np.array([w[design.columns[bounds[i] : bounds[i + 1]]] @ values[i] for i in range(n)]) + b
    curve, move, soft = np.array([1.0, 0.0]), Adam(2, 0.05), np.where(labels == 1, 0.98, 0.02)
    for _ in range(400):
        gap = sigmoid(curve[0] * margin + curve[1]) - soft
        curve = curve - move(np.array([(gap * margin).mean(), gap.mean()]))
    return Model(design.known, w * ratio, b, max(float(curve[0]), 1e-3), float(curve[1]))


def train(docs: DataFrame, labels: DataFrame, identifier: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    return fit(*labelled_sample(docs, labels, "quality", features, identifier, text, sample))


def score(docs: DataFrame, model: Model, identifier: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted) of every text; no shuffle."""
    kind = docs.schema[identifier].dataType.simpleString()

    def work(batches):
        for batch in batches:
            scores = model.scores(byte_texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=[identifier, "score"])

    scored = docs.select(identifier, text).mapInArrow(work, f"`{identifier}` {kind}, score double")
    return scored.select(
        identifier, held_out(identifier, 5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
