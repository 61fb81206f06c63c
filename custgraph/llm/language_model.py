"""Language-model scores from Elias-Fano n-gram tries, sharded by context and successor.

The model is a bigram model with absolute discounting and back-off: a seen pair has the probability
(c(v, w) - D) / c(v); an unseen one D * types(v) / c(v) times the unigram (c(w) + 1) / (N + V + 1); after
a context that training does not hold, the unigram alone. Log counts and back-off weights are kept in 16-bit steps.

Texts are packed in chunks: the chunk's words and the places of each text in them, a stored table. A chunk
asks for each of its distinct words and pairs once, and says how often training texts hold it; questions of
a chunk and shard travel together. A shard of pairs adds up the counts into its trie: contexts, pointers to
their successors, and successors relative to their context, all monotone and held as Elias-Fano sequences.
A question finds its context, reads begin and end of its successors from the pointers and looks for the
successor between them; sequences are never unpacked. A shard of words adds up words' counts and the types
that the shards of pairs found. Answers go back to their chunk, which adds them up for each text.

A context is dealt over a sixteenth of the shards by its successors, whatever its count, and a pair is one
question a chunk, so no word, pair or text fills a shard; only sums of counts reach the driver.
Counts of all texts are used; nothing is pruned, so the model grows with the corpus.

Defined results: a null or empty text is its end token alone; repeated rows are rows of their own with
equal scores; an empty training set leaves the unigram 1 / (N + V + 1); other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, forget
from .learn import held_out
from .words import byte_texts, chunks, hash_texts, mix

START, END = np.uint64(0x51ED270B0A1F39C7), np.uint64(0x8A3C5D7E91B24F60)
DISCOUNT = 0.75
SHARD = 1_500_000  # questions of a shard, about
SPREAD = 16  # a context is dealt over one in so many shards
CHUNK = 16 << 20  # bytes of texts packed together; a longer text makes a chunk of its own
STEP = 1 / 2048  # of a stored log10
KEY = 40  # bits of a successor's hash that tell it from the others of its context
ASKED = 1 << 16  # numbers looked up at once

_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
_COUNT = _BITS.sum(axis=1).astype(np.int64)
_PLACE = np.argsort(1 - _BITS, axis=1, kind="stable")  # of the k-th one of a byte


class EliasFano:
    """A monotone sequence of numbers below 2^63: low bits packed, high bits in unary with counts every 64 bits."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        top = int(values[-1]) if self.n else 0
        self.low = min(56, max(0, (top // max(1, self.n)).bit_length() - 1))
        self.top = top >> self.low
        places = np.arange(self.low, dtype=np.uint64)
        packed = [
            np.packbits(((values[at : at + ASKED, None] >> places) & np.uint64(1)).astype(np.uint8), bitorder="little")
            for at in range(0, self.n, ASKED)
        ]
        self.lows = np.concatenate([*packed, np.zeros(8, np.uint8)])
        unary = np.zeros(-(-(self.top + self.n + 1) // 64) * 64, np.uint8)
        unary[(values >> np.uint64(self.low)).astype(np.int64) + np.arange(self.n)] = 1
        self.highs = np.packbits(unary, bitorder="little").reshape(-1, 8)
        held = _COUNT[self.highs].sum(axis=1)
        self.ones = np.concatenate([[0], np.cumsum(held)[:-1]])
        self.zeros = 64 * np.arange(len(held)) - self.ones

    def _select(self, rank: np.ndarray, one: bool) -> np.ndarray:
        """Position of the one or zero of each rank in the high bits."""
        before = self.ones if one else self.zeros
        word = np.searchsorted(before, rank, side="right") - 1
        held = self.highs[word] if one else ~self.highs[word]
        upto = np.cumsum(_COUNT[held], axis=1)
        rest = rank - before[word]
        byte = (upto <= rest[:, None]).sum(axis=1)
        line = np.arange(len(rank))
        own = held[line, byte]
        return 64 * word + 8 * byte + _PLACE[own, rest - upto[line, byte] + _COUNT[own]]

    def at(self, places: np.ndarray) -> np.ndarray:
        """The numbers at the places."""
        high = (self._select(places, True) - places).astype(np.uint64)
        if not self.low:
            return high
        bit = places * self.low
        window = np.ndarray((len(self.lows) - 7,), "<u8", self.lows, strides=(1,))
        low = (window[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low) - 1)
        return (high << np.uint64(self.low)) | low

    def _below(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have smaller high bits."""
        out = np.where(high > self.top, self.n, 0)
        inner = (high > 0) & (high <= self.top)
        out[inner] = self._select(high[inner] - 1, False) - (high[inner] - 1)
        return out

    def successor(self, wanted: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first number in [begin, end) not below each wanted one, and whether it is the wanted one."""
        end = self.n if end is None else end
        begin, end = (np.broadcast_to(x, len(wanted)) for x in (begin, end))
        place, found = np.empty(len(wanted), np.int64), np.zeros(len(wanted), bool)
        for a in range(0, len(wanted), ASKED):
            part = slice(a, a + ASKED)
            place[part], found[part] = self._successor(wanted[part], begin[part], end[part])
        return place, found

    def _successor(self, wanted: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        high = (wanted >> np.uint64(self.low)).astype(np.int64)
        low, last = np.clip(self._below(high), begin, end), np.clip(self._below(high + 1), begin, end)
        open_ = np.flatnonzero(low < last)
        while len(open_):
            middle = (low[open_] + last[open_]) // 2
            less = self.at(middle) < wanted[open_]
            low[open_[less]] = middle[less] + 1
            last[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < last[open_]]
        found = np.zeros(len(wanted), bool)
        here = np.flatnonzero(low < end)
        found[here] = self.at(low[here]) == wanted[here]
        return low, found


def _steps(logs: np.ndarray) -> np.ndarray:
    return np.minimum(np.round(-logs / STEP), 65535).astype(np.uint16)


class Trie:
    """Contexts, their successors and the log10 of their discounted counts, from the counted pairs of a shard.

    Successors are given by ``KEY`` bits; pairs of no training text are not held."""

    UNSEEN = 65535

    def __init__(self, first: np.ndarray, second: np.ndarray, count: np.ndarray):
        first, second, count = first[count > 0], second[count > 0], count[count > 0]
        order = np.lexsort((second, first))
        first, second, count = first[order], second[order], count[order]
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        at = np.flatnonzero(new)
        count = np.add.reduceat(count, at) if len(at) else count
        first, second = first[at], second[at]
        self.names, begins = np.unique(first, return_index=True)
        ends = np.append(begins[1:], len(first))
        self.types = (ends - begins).astype(np.int64)
        self.contexts = EliasFano(self.names >> np.uint64(1))
        self.pointers = EliasFano(np.append(begins, len(first)).astype(np.uint64))
        owner = np.repeat(np.arange(len(self.names), dtype=np.uint64), self.types)
        self.successors = EliasFano((owner << np.uint64(KEY)) | second)
        # One step is added for counts of one, whose discounted log10 is negative.
        self.logs = np.round((np.log10(count - DISCOUNT) + 1) / STEP).astype(np.uint16)

    def ask(self, names: np.ndarray, sizes: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Steps of the log10 of a tenfold discounted count, or ``UNSEEN``; ``sizes`` questions follow each context."""
        out = np.full(len(second), self.UNSEEN, np.uint16)
        if not self.contexts.n:
            return out
        place, known = self.contexts.successor(names >> np.uint64(1))
        place = np.where(known, place, 0)
        begin = self.pointers.at(place).astype(np.int64)
        end = np.where(known, self.pointers.at(place + 1).astype(np.int64), begin)
        owner, begin, end = (np.repeat(x, sizes) for x in (place, begin, end))
        at, found = self.successors.successor((owner.astype(np.uint64) << np.uint64(KEY)) | second, begin, end)
        out[found] = self.logs[at[found]]
        return out


def _pack(*arrays: np.ndarray) -> bytes:
    """Compressed arrays; equal bytes of numbers side by side compress far better."""
    head = [len(arrays)]
    for x in arrays:
        head += [len(x), ord(x.dtype.char)]
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() for x in arrays]
    return zlib.compress(np.array(head, np.int64).tobytes() + b"".join(planes), 1)


def _unpack(blob: bytes) -> list[np.ndarray]:
    data = zlib.decompress(blob)
    count = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 2 * count, 8).reshape(-1, 2).tolist()
    at, out = 8 + 16 * count, []
    for size, char in head:
        kind = np.dtype(chr(char))
        plane = np.frombuffer(data, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(plane.T).view(kind).ravel())
        at += size * kind.itemsize
    return out


class Chunk:
    """Texts as places in a vocabulary that starts with the tokens of a text's begin and end."""

    def __init__(self, vocabulary: np.ndarray, code: np.ndarray, sizes: np.ndarray):
        self.vocabulary, self.code, self.sizes = vocabulary, code, sizes

    @staticmethod
    def of(words: np.ndarray, bounds: np.ndarray) -> Chunk:
        vocabulary, code = np.unique(words, return_inverse=True)
        return Chunk(np.concatenate([[START, END], vocabulary]).astype(np.uint64), (code + 2).astype(np.uint32), np.diff(bounds).astype(np.uint32))

    def tokens(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, context, word) of each token, the last one of a text being its end."""
        sizes = self.sizes.astype(np.int64) + 1
        ends = np.cumsum(sizes)
        second = np.ones(int(ends[-1]), np.int64)
        inside = np.ones(len(second), bool)
        inside[ends - 1] = False
        second[inside] = self.code
        first = np.concatenate([[0], second[:-1]])
        first[ends - sizes] = 0
        return np.repeat(np.arange(len(sizes)), sizes), first, second

    def pairs(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context, word) of the distinct pairs, and the pair of each token."""
        pair, at = np.unique(first * len(self.vocabulary) + second, return_inverse=True)
        return pair // len(self.vocabulary), pair % len(self.vocabulary), at

    def dealt(self, first: np.ndarray, second: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, shard, bounds) of pairs by shard, context and word."""
        name, word = self.vocabulary[first], self.vocabulary[second]
        part = mix(word, 7) % np.uint64(-(-shards // SPREAD))
        shard = (mix(name + part * np.uint64(0x9E3779B97F4A7C15), 8) % np.uint64(shards)).astype(np.int64)
        return _cut(np.lexsort((word, name, shard)), shard)

    def dealt_words(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _cut_words(self.vocabulary, shards)


def _cut(order: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shard = shard[order]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1]).astype(np.int64)
    return order, shard[starts], np.append(starts, len(shard))


def _cut_words(words: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shard = (mix(words, 11) % np.uint64(shards)).astype(np.int64)
    return _cut(np.lexsort((words, shard)), shard)


def _packed(docs: DataFrame) -> DataFrame:
    """(chunk, ids, train, n_words, n_pairs, body) of rows (id, train, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def listed(values):
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def work(batches):
        for batch in batches:
            texts = byte_texts(batch.column(2))
            for a, b in chunks(texts, CHUNK):
                one = Chunk.of(*hash_texts(texts[a:b]))
                _, first, second = one.tokens()
                pairs = len(np.unique(first * len(one.vocabulary) + second))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex]), listed(pa.concat_arrays([batch.column(0).slice(a, b - a)])),
                     listed(pa.concat_arrays([batch.column(1).slice(a, b - a)])), pa.array([len(one.vocabulary)], pa.int64()),
                     pa.array([pairs], pa.int64()), pa.array([_pack(one.vocabulary, one.code, one.sizes)], pa.binary())],
                    names=["chunk", "ids", "train", "n_words", "n_pairs", "body"],
                )

    return docs.mapInArrow(work, f"chunk string, ids array<{kind}>, train array<boolean>, n_words long, n_pairs long, body binary")


_DEALT = "shard int, chunk string, body binary"


def _dealt(shard, chunk, body) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([int(shard)], pa.int32()), pa.array([chunk], pa.string()), pa.array([body], pa.binary())], names=["shard", "chunk", "body"])


def _each_chunk(batches):
    """(name, marks of training texts, chunk) of rows (chunk, train, body)."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column(0)[i].as_py(), np.array(batch.column(1)[i].as_py(), bool), Chunk(*_unpack(batch.column(2)[i].as_py()))


def _pair_questions(packed: DataFrame, shards: int) -> DataFrame:
    def work(batches):
        for name, train, chunk in _each_chunk(batches):
            text, first, second = chunk.tokens()
            a, b, at = chunk.pairs(first, second)
            count = np.bincount(at, train[text], minlength=len(a)).astype(np.uint32)
            order, shard, bounds = chunk.dealt(a, b, shards)
            word, key, count = chunk.vocabulary[a[order]], chunk.vocabulary[b[order]] >> np.uint64(64 - KEY), count[order]
            for s, x, y in zip(shard.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                names, sizes = np.unique(word[x:y], return_counts=True)
                yield _dealt(s, name, _pack(names, sizes.astype(np.uint32), key[x:y], count[x:y]))

    return packed.select("chunk", "train", "body").mapInArrow(work, _DEALT)


def _word_questions(packed: DataFrame, shards: int) -> DataFrame:
    def work(batches):
        for name, train, chunk in _each_chunk(batches):
            text, _, second = chunk.tokens()
            count = np.bincount(second, train[text], minlength=len(chunk.vocabulary)).astype(np.uint32)
            count[0] = train.sum()
            order, shard, bounds = chunk.dealt_words(shards)
            words, count = chunk.vocabulary[order], count[order]
            for s, x, y in zip(shard.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                yield _dealt(s, name, _pack(words[x:y], count[x:y]))

    return packed.select("chunk", "train", "body").mapInArrow(work, _DEALT)


def _by_shard(asked: DataFrame, shards: int, answer, schema: str) -> DataFrame:
    """``answer(shard, [(chunk, body)])`` for all rows of each shard."""

    def work(batches):
        current, held = None, []
        for batch in batches:
            for shard, chunk, body in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != current and held:
                    yield from answer(current, held)
                    held = []
                current = shard
                held.append((chunk, body))
        if held:
            yield from answer(current, held)

    return asked.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(work, schema)


def _answer_pairs(word_shards: int):
    """Answers for each chunk, and, with the chunk null, (contexts, types) for the shards of words."""

    def answer(shard, rows):
        asked = [_unpack(body) for _, body in rows]
        names, sizes, key, count = (np.concatenate([a[i] for a in asked]) for i in range(4))
        trie = Trie(np.repeat(names, sizes), key, count.astype(np.int64))
        told = trie.ask(names, sizes, key)
        at = 0
        for (chunk, _), one in zip(rows, asked):
            yield _dealt(shard, chunk, _pack(told[at : at + len(one[2])]))
            at += len(one[2])
        if len(trie.names):
            order, shards, bounds = _cut_words(trie.names, word_shards)
            for s, x, y in zip(shards.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                yield _dealt(s, None, _pack(trie.names[order[x:y]], trie.types[order[x:y]]))

    return answer


def _answer_words(shard, rows):
    """(counts, steps of the back-off weight) for each chunk, and, with the chunk null, the shard's N and V."""
    asked = [(chunk, *_unpack(body)) for chunk, body in rows]
    names = np.unique(np.concatenate([a[1] for a in asked]))
    level = EliasFano(names >> np.uint64(1))
    total, types = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    places = [level.successor(words >> np.uint64(1))[0] for _, words, _ in asked]
    for (chunk, _, numbers), at in zip(asked, places):
        np.add.at(types if chunk is None else total, at, numbers.astype(np.int64))
    share = np.minimum(DISCOUNT * np.maximum(types, 1) / np.maximum(total, 1), 1.0)
    backoff = _steps(np.log10(np.where(total > 0, share, 1.0)))

    def row(chunk, body, n, v):
        arrays = [pa.array([int(shard)], pa.int32()), pa.array([chunk], pa.string()), pa.array([body], pa.binary()), pa.array([n], pa.int64()), pa.array([v], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["shard", "chunk", "body", "n", "v"])

    for (chunk, _, _), at in zip(asked, places):
        if chunk is not None:
            yield row(chunk, _pack(total[at], backoff[at]), 0, 0)
    real = names != START
    yield row(None, None, int(total[real].sum()), int((total[real] > 0).sum()))


def _summed(rows: DataFrame, kind: str, word_shards: int, shards: int, log_all: float) -> DataFrame:
    """(id, train, n_tokens, n_known, base, score) of rows (chunk, part, shard, ids, train, body): part 0 is the
    chunk, 1 the answers on its words, 2 those on its pairs; they follow each other."""
    names = ["id", "train", "n_tokens", "n_known", "base", "score"]

    def score(ids, train, body, answers):
        chunk = Chunk(*_unpack(body))
        texts = len(chunk.sizes)
        text, first, second = chunk.tokens()
        a, b, at = chunk.pairs(first, second)
        told = [_unpack(x) for x in answers[1]]
        order = chunk.dealt_words(word_shards)[0]
        count, backoff = np.empty(len(order), np.int64), np.empty(len(order), np.uint16)
        count[order], backoff[order] = (np.concatenate([t[i] for t in told]) for i in (0, 1))
        steps = np.empty(len(a), np.uint16)
        steps[chunk.dealt(a, b, shards)[0]] = np.concatenate([_unpack(x)[0] for x in answers[2]])
        single = np.log10(count + 1.0) - log_all
        seen = steps != Trie.UNSEEN
        known = count[a] > 0
        logs = np.where(
            seen, steps * STEP - 1 - np.log10(np.maximum(count[a], 1)), single[b] - np.where(known, backoff[a] * STEP, 0.0)
        )
        sums = [np.bincount(text, x, minlength=texts) for x in ((count > 0)[second], single[second], logs[at])]
        return pa.RecordBatch.from_arrays(
            [ids, train, pa.array(chunk.sizes.astype(np.int64) + 1), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], names=names
        )

    def work(batches):
        current = None
        for batch in batches:
            for i in range(batch.num_rows):
                part, body = batch.column(1)[i].as_py(), batch.column(5)[i].as_py()
                if part == 0:
                    if current is not None:
                        yield score(*current)
                    current = (batch.column(3)[i].values, batch.column(4)[i].values, body, {1: [], 2: []})
                else:
                    current[3][part].append(body)
        if current is not None:
            yield score(*current)

    return rows.mapInArrow(work, f"id {kind}, train boolean, n_tokens long, n_known long, base double, score double")


def score(docs: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    kind = docs.schema[identifier].dataType.simpleString()
    packed = cut_lineage(_packed(docs.select(F.col(identifier).alias("id"), (~held_out(identifier, 7, 2)).alias("train"), F.col(text).alias("text"))))
    words, pairs, parts = packed.agg(F.sum("n_words"), F.sum("n_pairs"), F.count(F.lit(1))).first()
    word_shards, shards = max(1, -(-(words or 0) // SHARD)), max(1, -(-(pairs or 0) // SHARD))
    on_pairs = cut_lineage(_by_shard(_pair_questions(packed, shards), shards, _answer_pairs(word_shards), _DEALT))
    asked = _word_questions(packed, word_shards).unionByName(on_pairs.where("chunk is null"))
    on_words = cut_lineage(_by_shard(asked, word_shards, _answer_words, f"{_DEALT}, n long, v long"))
    n, v = on_words.where("chunk is null").agg(F.sum("n"), F.sum("v")).first()
    n, v = n or 0, v or 0
    ids, train = (F.lit(None).cast(packed.schema[c].dataType).alias(c) for c in ("ids", "train"))
    rows = packed.select("chunk", F.lit(0).alias("part"), F.lit(0).alias("shard"), "ids", "train", "body")
    for part, told in ((1, on_words), (2, on_pairs)):
        rows = rows.unionByName(told.where("chunk is not null").select("chunk", F.lit(part).alias("part"), "shard", ids, train, "body"))
    ordered = rows.repartition(max(1, -(-parts // 2)), "chunk").sortWithinPartitions("chunk", "part", "shard")
    summed = cut_lineage(_summed(ordered, kind, word_shards, shards, float(np.log10(n + v + 1))))
    for frame in (packed, on_pairs, on_words):
        forget(frame)
    return summed.select(
        F.col("id").alias(identifier), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
    )
