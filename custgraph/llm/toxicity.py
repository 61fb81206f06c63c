"""Toxicity by cumulative-link ordinal regression over sparse indicators of words and their beginnings.

P(grade > k) = sigmoid(w.x - t_k) with one weight vector for all grades and rising thresholds t_k.
The labels are 0 or 1, so grades are made from them: label 0 is grade 0; label 1 is graded by the
number of features of the text that tell of the class (log-odds of at least ``TELLING`` in the
sample): 1 for up to one such feature, 2 for two or three, 3 for more. Expected severity is the sum of
P(grade > k) over k; a text is rejected when P(grade > 0) is at least ``REJECT``.

The model is fitted on at most ``learn.SAMPLE`` labelled rows; every text is scored whole.
Defined results: a null or empty text is scored by the thresholds alone; without labels of both
classes nothing is rejected and severity is 0; repeated rows give one row each; other columns are
not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .learn import SAMPLE, Adam, Design, labelled_sample, lookup, sigmoid
from .words import ALNUM, byte_texts, chunks, hash_texts, mix

GRADES = 4
TELLING = 2.0
REJECT = 0.4
BEGINNINGS = (4, 5, 6, 7)  # bytes of a word's beginning
CERTAIN = 3.0  # deviations by which a feature's log-odds must differ from 0 to be in the model
OFTEN = (3, 6)  # a beginning that occurs so often in a text is a feature of its own
_WORD = b"[" + b"".join(re.escape(bytes([i])) for i in range(256) if ALNUM[i]) + b"]"
CUTS = {size: re.compile(b"(" + _WORD + b"{%d})" % size + _WORD + b"+") for size in BEGINNINGS}


def text_features(texts: list[bytes]) -> list[np.ndarray]:
    """For each text, hashes of its distinct words, and of the beginnings of words by how often they occur."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for size in (0, *BEGINNINGS):
        words, bounds = hash_texts([CUTS[size].sub(rb"\1", x.lower()) for x in texts] if size else texts, ALNUM)
        for i, held in enumerate(out):
            names, counts = np.unique(words[bounds[i] : bounds[i + 1]], return_counts=True)
            held.append(mix(names, 10 * size))
            held += [mix(names[counts >= least], 10 * size + least) for least in OFTEN if size]
    return [np.unique(np.concatenate(held)) for held in out]


def features(text: bytes) -> np.ndarray:
    return text_features([text])[0]


@dataclass
class Model:
    known: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, margin: np.ndarray) -> np.ndarray:
        """P(grade > k) for k = 0..GRADES-2, one row for each margin."""
        return np.where(np.isinf(self.thresholds), 0.0, sigmoid(margin[:, None] - self.thresholds[None, :]))


def log_odds(design: Design, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of class 1 for each feature, and the same in standard deviations."""
    size, toxic = len(design.known), labels[design.row_of] == 1
    hits = np.bincount(design.columns[toxic], minlength=size) + 0.1
    misses = np.bincount(design.columns[~toxic], minlength=size) + 0.1
    odds = np.log(hits / max(1, (labels == 1).sum())) - np.log(misses / max(1, (labels == 0).sum()))
    return odds, odds / np.sqrt(1 / (hits + 1) + 1 / (misses + 1))


def fit(rows: list[np.ndarray], labels: np.ndarray, steps: int = 300, penalty: float = 0.1) -> Model:
    """Weights and thresholds by likelihood, from feature rows and 0/1 labels."""
    if len(set(labels.tolist())) < 2:
        return Model(np.empty(0, np.uint64), np.empty(0), np.full(GRADES - 1, np.inf))
    design = Design.of(rows, least=3)
    odds, certain = log_odds(design, labels)
    design = design.reduced(np.abs(certain) >= CERTAIN)
    odds, size, n, row_of = odds[np.abs(certain) >= CERTAIN], len(design.known), len(rows), design.row_of
    telling = np.bincount(row_of, (odds >= TELLING)[design.columns], minlength=n)
    grade = np.where(labels == 1, 1 + (telling >= 2) + (telling >= 4), 0)
    parameters = np.concatenate([np.zeros(size), [0.5], np.log(np.ones(GRADES - 2))])
    move = Adam(len(parameters), 0.05)
    for _ in range(steps):
        w, first, gaps = parameters[:size], parameters[size], np.exp(parameters[size + 1 :])
        t = first + np.concatenate([[0.0], np.cumsum(gaps)])
        margin = np.bincount(row_of, w[design.columns], minlength=n)
        above = np.hstack([np.ones((n, 1)), sigmoid(margin[:, None] - t), np.zeros((n, 1))])
        here = np.maximum(above[np.arange(n), grade] - above[np.arange(n), grade + 1], 1e-12)
        slope = above * (1 - above)
        upper, lower = slope[np.arange(n), grade] / here, slope[np.arange(n), grade + 1] / here
        by_margin = lower - upper  # of the negative log-likelihood
        by_t = np.zeros(GRADES + 1)
        np.add.at(by_t, grade, upper)
        np.add.at(by_t, grade + 1, -lower)
        by_t = by_t[1:GRADES]
        by_gap = np.cumsum(by_t[::-1])[::-1][1:] * gaps
        gradient = np.concatenate([
            np.bincount(design.columns, by_margin[row_of], minlength=size) / n + penalty * w / n * 10, [by_t.sum() / n], by_gap / n,
        ])
        parameters = parameters - move(gradient)
    t = parameters[size] + np.concatenate([[0.0], np.cumsum(np.exp(parameters[size + 1 :]))])
    return Model(design.known, parameters[:size], t)


def train(docs: DataFrame, labels: DataFrame, identifier: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    return fit(*labelled_sample(docs, labels, "toxic", features, identifier, text, sample))


def margins(texts: list[bytes], model: Model) -> np.ndarray:
    out = []
    for a, b in chunks(texts):
        out += [model.weights[lookup(model.known, x)].sum() for x in text_features(texts[a:b])]
    return np.array(out, float)


def score(docs: DataFrame, model: Model, identifier: str = "doc_id", text: str = "text", reject: float = REJECT) -> DataFrame:
    """(id, severity, p_toxic, grade, rejected) of every text; no shuffle. ``grade`` is the likeliest."""
    kind = docs.schema[identifier].dataType.simpleString()

    def work(batches):
        for batch in batches:
            above = model.above(margins(byte_texts(batch.column(1)), model))
            padded = np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above.sum(axis=1)), pa.array(above[:, 0]),
                 pa.array((padded[:, :-1] - padded[:, 1:]).argmax(axis=1).astype(np.int32)), pa.array(above[:, 0] >= reject)],
                names=[identifier, "severity", "p_toxic", "grade", "rejected"],
            )

    return docs.select(identifier, text).mapInArrow(work, f"`{identifier}` {kind}, severity double, p_toxic double, grade int, rejected boolean")


def accepted(docs: DataFrame, model: Model, text: str = "text", reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns kept."""
    at = docs.columns.index(text)

    def work(batches):
        for batch in batches:
            toxic = model.above(margins(byte_texts(batch.column(at)), model))[:, 0] >= reject
            yield batch.filter(pa.array(~toxic))

    return docs.mapInArrow(work, docs.schema)
