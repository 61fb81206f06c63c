"""Repeated passages by induced suffix sorting, in shards that hold all places where a passage may stand.

A window is a passage of ``length`` bytes. Its anchor is the ``GRAM`` bytes in it of the smallest hash, so equal
windows have equal anchors at equal places. Windows in a row with one anchor make a piece of text. Pieces
of anchors that stand in one place only are done. Equal pieces are one piece with a weight; a weight of two
answers for all its windows. Where an anchor has several distinct pieces, these go to the shard of the
anchor, each with its text once. Spark deals, sorts and spills the shards; one has about ``SHARD`` bytes.

A shard sorts its suffixes by induction. Suffixes that begin a rise after a fall are the stars. A suffix
is a tuple: its symbols up to the next star, then the rank of that star. Tuples of stars get names by their symbols; the
sequence of names is sorted by recursion unless they are unique, which gives the ranks of stars, and these the order of all windows.
Common prefixes are carried along: two windows with equal symbols share these and what their stars share, the
least common prefix between the stars' ranks. A window that shares ``length`` bytes with its neighbor is repeated.

An anchor with more than ``HOT`` distinct pieces would fill a shard of its own. Its pieces are cut again, into slices
of ``SLICE`` windows that stand alike around the anchor; all windows of a slice hold the same ``length - SLICE + 1`` bytes,
which are the anchor of the slice, and slices go the way of pieces. Where even these have more than ``HOT``
distinct slices, windows are compared by 128-bit fingerprints. All three ways are exact.

Defined results: null and empty texts have no bytes and lose none; texts shorter than ``length`` lose none;
rows equal in text are removed alike, each for the other; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, forget
from .words import byte_texts, chunks, mix

LENGTH, GRAM = 400, 32
SHARD = 1 << 20  # bytes of pieces sorted together, about
HOT = 1024  # distinct pieces of an anchor in a shard
SLICE = 16  # windows of a slice
SPAN = 1 << 19  # bytes of texts taken at once; a longer text is taken in runs of so many windows
_PLACE = np.uint64((1 << 20) - 1)
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _bytes8(data: bytes) -> np.ndarray:
    """The eight bytes at each place of ``data`` as one number."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,))


def _gram_hashes(data: bytes) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at each place."""
    eight = _bytes8(data)
    grams = len(data) - GRAM + 1
    total = eight[:grams] * _FACTORS[0]
    for i in range(1, GRAM // 8):
        total += eight[8 * i : 8 * i + grams] * _FACTORS[i]
    return mix(total, 21)


def _piece_runs(data: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last-but-one window start and anchor of each piece of the joined texts that end at ``ends``."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = _gram_hashes(data)
    grams = len(hashes)
    low = (hashes & ~_PLACE) | np.arange(grams, dtype=np.uint64)
    span, wide = length - GRAM + 1, 1
    while 2 * wide <= span:
        low = np.minimum(low[:-wide], low[wide:])
        wide *= 2
    if wide < span:
        low = np.minimum(low[: len(low) - (span - wide)], low[span - wide :])
    starts = np.concatenate([[0], ends[:-1]])
    fits = np.zeros(len(data) + 1, np.int8)
    long = ends - starts >= length
    fits[starts[long]] = 1
    fits[ends[long] - length + 1] -= 1
    at = np.flatnonzero(np.cumsum(fits, dtype=np.int8)[: len(low)])
    anchor = (low[at] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    return at[first], at[np.append(first[1:], len(at)) - 1] + 1 if len(at) else at, hashes[anchor[first]]


def _spans(texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, text of each span, its place in the text, its end in the bytes): texts side by side, long ones in overlapping parts."""
    for a, b in chunks(texts, SPAN):
        if b == a + 1 and len(texts[a]) > SPAN:
            for at in range(0, len(texts[a]) - length + 1, SPAN - length):
                part = texts[a][at : at + SPAN - 1]
                yield part, np.array([a]), np.array([at]), np.array([len(part)])
        else:
            ends = np.cumsum([len(x) for x in texts[a:b]])
            yield b"".join(texts[a:b]), np.arange(a, b), np.zeros(b - a, np.int64), ends


def _places(docs: DataFrame, length: int) -> DataFrame:
    """(doc, anchor, piece, start, windows) of the pieces of all texts (doc, text); ``piece`` is a hash of its bytes."""

    def work(batches):
        for batch in batches:
            texts = byte_texts(batch.column(1))
            for data, of, place, ends in _spans(texts, length):
                first, last, anchor = _piece_runs(data, ends, length)
                span = np.searchsorted(ends, first, side="right")
                begins = np.concatenate([[0], ends[:-1]])
                digests = [blake2b(data[a : b + length - 1], digest_size=8).digest() for a, b in zip(first.tolist(), last.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of[span])), pa.array(anchor.view(np.int64)), pa.array(np.frombuffer(b"".join(digests), np.int64)),
                     pa.array((first - begins[span] + place[span]).astype(np.int32)), pa.array((last - first).astype(np.int32))],
                    names=["doc", "anchor", "piece", "start", "windows"],
                )

    return docs.mapInArrow(work, "doc binary, anchor long, piece long, start int, windows int")


def _stars(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each suffix rises (is below the next one), the stars, and the next star of each place, for the last one itself."""
    n = len(symbols)
    turns = np.flatnonzero(symbols[1:] != symbols[:-1])
    rises = np.repeat(np.append(symbols[turns] < symbols[turns + 1], True), np.diff(np.concatenate([[-1], turns, [n - 1]])))
    stars = np.flatnonzero(rises[1:] & ~rises[:-1]) + 1
    after = np.searchsorted(stars, np.arange(n), side="right")
    return rises, stars, np.append(stars, n - 1)[after]


def _names(symbols: np.ndarray, rises: np.ndarray, ends: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Rank of the tuple (symbols to the next star) at each of ``places``; equal tuples have equal ranks."""
    coded = symbols.astype(np.uint64) * np.uint64(2) + rises
    bits = max(1, int(coded.max()).bit_length())
    step = max(1, 63 // bits)
    padded = np.append(coded, np.zeros(step, np.uint64))
    masks = np.array([((1 << (bits * j)) - 1) << (bits * (step - j)) for j in range(step + 1)], np.uint64)
    held = ends[places] - places + 1  # symbols of a tuple

    def key(at, left):
        total = np.zeros(len(at), np.uint64)
        for j in range(step):
            total = (total << np.uint64(bits)) | padded[at + j]
        return total & masks[np.minimum(left, step)]

    def ranked(order, differs):
        new = np.append(True, differs)
        out = np.empty(len(order), np.int64)
        out[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        return out

    first = key(places, held)
    order = np.argsort(first, kind="stable")
    names, done = ranked(order, np.diff(first[order]) != 0), step
    active = np.flatnonzero(held > done)
    while len(active):
        size = np.bincount(names[active], minlength=1)
        active = active[size[names[active]] > 1]
        if not len(active):
            break
        more = key(places[active] + done, held[active] - done)
        order = np.lexsort((more, names[active]))
        base = names[active][order]
        at = ranked(order, (np.diff(base) != 0) | (np.diff(more[order]) != 0))
        start = np.empty(len(active), np.int64)  # where the group of a tuple begins among the active ones
        start[order] = np.flatnonzero(np.append(True, np.diff(base) != 0))[np.cumsum(np.append(True, np.diff(base) != 0)) - 1]
        names[active] += at - start
        done += step
        active = active[held[active] > done]
    return names


def _star_ranks(symbols: np.ndarray, rises: np.ndarray, stars: np.ndarray, ends: np.ndarray) -> np.ndarray:
    names = _names(symbols, rises, ends, stars)
    kinds, reduced = np.unique(names, return_inverse=True)
    return reduced if len(kinds) == len(stars) else suffix_ranks(reduced)


def suffix_ranks(symbols: np.ndarray) -> np.ndarray:
    """Rank of each suffix; the last symbol is the smallest and stands nowhere else."""
    if len(symbols) == 1:
        return np.zeros(1, np.int64)
    rises, stars, ends = _stars(symbols)
    induced = _star_ranks(symbols, rises, stars, ends)[np.searchsorted(stars, ends)]
    order = np.lexsort((induced, _names(symbols, rises, ends, np.arange(len(symbols)))))
    ranks = np.empty(len(symbols), np.int64)
    ranks[order] = np.arange(len(symbols))
    return ranks


def _common(data: bytes, left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Common prefix of the places of each pair, up to ``most``."""
    eight = _bytes8(data + bytes(8 + int(most.max(initial=0))))
    shared, active = most.copy(), np.flatnonzero(most > 0)
    at = 0
    while len(active):
        differs = eight[left[active] + at] ^ eight[right[active] + at]
        apart = np.flatnonzero(differs)
        lowest = differs[apart] & (~differs[apart] + np.uint64(1))
        zeros = (np.frexp(lowest.astype(np.float64))[1] - 1) // 8
        shared[active[apart]] = np.minimum(shared[active[apart]], at + zeros)
        at += 8
        active = active[differs == 0]
        active = active[most[active] > at]
    return shared


class _RangeMin:
    """Least value between two places of an array."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 ** len(self.rows) <= len(values):
            last, half = self.rows[-1], 2 ** (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of [start, end), not empty."""
        level = np.frexp((end - start).astype(np.float64))[1] - 1
        out = np.empty(len(start), self.rows[0].dtype)
        for k in np.unique(level).tolist():
            here = level == k
            out[here] = np.minimum(self.rows[k][start[here]], self.rows[k][end[here] - 2**k])
        return out


def repeated_windows(pieces: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each distinct piece, which of its windows of ``length`` bytes also start elsewhere in the pieces."""
    sizes = np.array([len(x) for x in pieces])
    stops = np.cumsum(sizes + 1) - 1
    data = b"\0".join(pieces) + b"\0"
    n = len(pieces)
    symbols = np.frombuffer(data, np.uint8).astype(np.int64) + n
    symbols[stops] = np.arange(n)[::-1]
    rises, stars, ends = _stars(symbols)
    ranks = _star_ranks(symbols, rises, stars, ends)
    rest = np.repeat(stops, sizes + 1) - np.arange(len(data))  # bytes up to the end of the piece
    sorted_stars = np.empty(len(stars), np.int64)
    sorted_stars[ranks] = stars
    most = np.minimum(np.minimum(rest[sorted_stars[1:]], rest[sorted_stars[:-1]]), length)
    between = np.append(0, _common(data, sorted_stars[:-1], sorted_stars[1:], most)).astype(np.int16)
    windows = np.flatnonzero(rest >= length)
    names = _names(symbols, rises, ends, windows)
    star = ranks[np.searchsorted(stars, ends[windows])]
    order = np.lexsort((star, names))
    left, right = order[:-1], order[1:]
    same = names[left] == names[right]
    shared = np.zeros(len(left), np.int64)
    reach = ends[windows] - windows
    shared[same] = reach[left[same]] + _RangeMin(between).between(star[left[same]] + 1, star[right[same]] + 1)
    apart = np.flatnonzero(~same)  # the symbols' directions may differ where the bytes agree, by what follows a run of one byte
    shared[apart] = _common(data, windows[left[apart]], windows[right[apart]], np.full(len(apart), length))
    found = np.zeros(len(data), bool)
    found[windows[left[shared >= length]]] = found[windows[right[shared >= length]]] = True
    return [found[b - s : b - length + 1] for b, s in zip(stops.tolist(), sizes.tolist())]


def _bounds(marks: np.ndarray) -> list[int]:
    """Begin and end of each run of marks, side by side."""
    return np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))).tolist()


_FOUND = "anchor long, piece long, runs array<int>"


def _found(rows: list[tuple[int, int, list[int]]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["anchor", "piece", "runs"])


def _sorted_shards(asked: DataFrame, length: int) -> DataFrame:
    """(anchor, piece, runs of repeated windows) of rows (shard, anchor, piece, weight, text) sorted by shard."""

    def work(batches):
        current, held = None, []
        for batch in batches:
            for shard, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != current and held:
                    yield answer(held)
                    held = []
                current = shard
                held.append(row)
        if held:
            yield answer(held)

    def answer(held):
        marks = repeated_windows([r[3] for r in held], length)
        runs = [[0, len(m)] if r[2] > 1 else _bounds(m) for r, m in zip(held, marks)]
        return _found([(r[0], r[1], x) for r, x in zip(held, runs) if x])

    return asked.mapInArrow(work, _FOUND)


def _slices(cut: DataFrame, length: int) -> DataFrame:
    """(doc, anchor, piece, start, windows, copies) of the slices of pieces (anchor, piece, weight, text); the piece is their doc."""

    def work(batches):
        for batch in batches:
            out = []
            for anchor, piece, weight, text in zip(*(batch.column(c).to_pylist() for c in ("anchor", "piece", "weight", "text"))):
                n = len(text) - length + 1
                at = int(np.argmax(_gram_hashes(text).view(np.int64) == anchor))
                for k in range((at - n + 1) // SLICE, at // SLICE + 1):
                    first, last = max(0, at - SLICE * k - SLICE + 1), min(n, at - SLICE * k + 1)
                    core = text[at - SLICE * k : at - SLICE * k - SLICE + 1 + length]
                    digests = (blake2b(x, digest_size=8, person=b"%d" % k).digest() for x in (core, text[first : last + length - 1]))
                    out.append((f"{anchor}:{piece}", *(int.from_bytes(d, "little", signed=True) for d in digests), first, last - first, weight))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
            names = ["doc", "anchor", "piece", "start", "windows", "copies"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    return cut.mapInArrow(work, "doc string, anchor long, piece long, start int, windows int, copies long")


def _fingerprints(cut: DataFrame, length: int) -> DataFrame:
    """(anchor, piece, runs) of pieces (anchor, piece, weight, text), by the fingerprints of their windows."""

    def prints(batches):
        for batch in batches:
            for anchor, piece, weight, text in zip(*(batch.column(c).to_pylist() for c in ("anchor", "piece", "weight", "text"))):
                n = len(text) - length + 1
                digests = pa.array([blake2b(text[i : i + length], digest_size=16).digest() for i in range(n)], pa.binary())
                same = [pa.array([x] * n, pa.int64()) for x in (anchor, piece, weight)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(range(n), pa.int32()), digests], names=["anchor", "piece", "weight", "at", "print"])

    rows = cut.mapInArrow(prints, "anchor long, piece long, weight long, at int, print binary")
    twice = rows.groupBy("print").agg(F.sum("weight").alias("all")).where(F.col("all") > 1).select("print")
    runs = F.flatten(F.transform(F.array_sort(F.collect_list("at")), lambda i: F.array(i, i + 1))).alias("runs")
    return rows.join(twice, "print").groupBy("anchor", "piece").agg(runs)


def _repeats(places: DataFrame, texts: DataFrame, length: int, shard: int, hot: int, slices: bool = True) -> DataFrame:
    """(anchor, piece, runs of repeated windows), a stored table, of pieces at (doc, anchor, piece, start, windows, copies)
    of texts (doc, text in bytes); ``slices`` are cut from pieces of hot anchors."""
    # One row for each distinct piece; its text is taken from the place with the smallest mark.
    mark = F.xxhash64("doc", "start")
    pieces = places.groupBy("anchor", "piece").agg(
        F.sum("copies").alias("weight"), F.min(mark).alias("mark"), F.max("windows").alias("windows")
    )
    anchors = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("distinct"), F.sum("weight").alias("all")).where(F.col("all") > 1)
    repeated = cut_lineage(pieces.join(anchors.select("anchor", "distinct"), "anchor"))
    several = repeated.where("distinct > 1")
    total = several.where(F.col("distinct") <= hot).agg(F.sum(F.col("windows") + length)).first()[0] or 0
    shards = max(1, -(-total // shard))
    wanted = several.select("anchor", "piece", "weight", "mark", "distinct").join(
        places.select("anchor", "piece", "doc", "start", "windows", mark.alias("mark")), ["anchor", "piece", "mark"]
    )
    asked = wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "piece", "weight", "distinct", "start", "windows")).alias("asked"))
    cut = cut_lineage(
        texts.join(asked, "doc").select("text", F.explode("asked").alias("a"))
        .select("a.*", F.expr(f"substring(text, a.start + 1, a.windows + {length - 1})").alias("text"))
        .withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
        .dropDuplicates(["anchor", "piece"])
    )
    parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.where(F.col("distinct") <= hot).select("shard", "anchor", "piece", "weight", "text")
    found = _sorted_shards(dealt.repartition(min(shards, 4 * parts), "shard").sortWithinPartitions("shard"), length)
    found = found.unionByName(repeated.where("distinct = 1").select("anchor", "piece", F.array(F.lit(0), F.col("windows")).alias("runs")))
    crowded, spent = cut.where(F.col("distinct") > hot).select("anchor", "piece", "weight", "text"), [repeated, cut]
    if several.where(F.col("distinct") > hot).isEmpty():
        pass
    elif slices:
        made = cut_lineage(_slices(crowded, length))
        name = F.concat_ws(":", "anchor", "piece")
        inside = _repeats(made, crowded.select(name.alias("doc"), "text"), length, shard, hot, False)
        moved = F.transform("runs", lambda x: x + F.col("start"))
        runs = made.join(inside, ["anchor", "piece"]).groupBy("doc").agg(F.flatten(F.collect_list(moved)).alias("runs"))
        ids = [F.split("doc", ":")[i].cast("long").alias(c) for i, c in enumerate(("anchor", "piece"))]
        found = found.unionByName(runs.select(*ids, "runs"))
        spent += [made, inside]
    else:
        found = found.unionByName(_fingerprints(crowded, length))
    found = cut_lineage(found)
    for frame in spent:
        forget(frame)
    return found


def _kept(joined: DataFrame, length: int) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept_sha256) of rows (doc, text, found: list of (start, runs))."""

    def work(batches):
        for batch in batches:
            out = []
            for doc, text, found in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), batch.column(2).to_pylist()):
                edges = np.zeros(len(text) + 1, np.int32)
                for f in found or ():
                    np.add.at(edges, np.array(f["runs"][::2], np.int64) + f["start"], 1)
                    np.add.at(edges, np.array(f["runs"][1::2], np.int64) + f["start"] + length - 1, -1)
                gone = np.cumsum(edges)[:-1] > 0
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if found else text
                out.append((doc, len(text), int(gone.sum()), len(_bounds(gone)) // 2, sha256(kept).hexdigest()))
            names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    return joined.mapInArrow(work, "doc binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(
    docs: DataFrame, length: int = LENGTH, identifier: str = "doc_id", text: str = "text", shard: int = SHARD, hot: int = HOT
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of each row: what is left without the bytes that any string
    of ``length`` bytes covers which also starts elsewhere in the texts."""
    held = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(identifier).alias("id"), F.unhex(F.md5(held)).alias("doc"), held.alias("text"))
    places = cut_lineage(
        _places(rows.select("doc", "text"), length).groupBy("doc", "anchor", "piece", "start", "windows").agg(F.count(F.lit(1)).alias("copies"))
    )
    distinct = rows.groupBy("doc").agg(F.first("text").alias("text"))
    found = _repeats(places, distinct.select("doc", F.encode("text", "utf-8").alias("text")), length, shard, hot)
    spans = places.join(found, ["anchor", "piece"]).groupBy("doc").agg(F.collect_list(F.struct("start", "runs")).alias("found"))
    kept = cut_lineage(_kept(distinct.join(spans, "doc", "left").select("doc", "text", "found"), length))
    result = rows.select(F.col("id").alias(identifier), "doc").join(kept, "doc").select(
        identifier, "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
    for frame in (places, found):
        forget(frame)
    return result
