"""Near-duplicates by HyperMinHash: banded compressed registers, a corrected estimate, then full sets.

A text's set holds the 64-bit hashes of its distinct shingles. The top bits of a hash choose one of
``REGISTERS`` buckets; the smallest rest of a bucket is kept as its number of leading zeros and
``MANTISSA`` bits after them. An empty bucket copies the first filled one in an order of its own, so
that each register matches with the probability of the Jaccard similarity whatever the set's size.

Equal sets are one node from the start, so copies cost nothing more. Nodes that agree on a band of
``BAND`` registers meet in a group. In two rounds each node is compared with one leader, the one it
shares most bands with, so families join up by few comparisons. What remains are groups that still
hold two components: their nodes travel with their registers in blocks of ``BLOCK`` a side, and a task
gives only the pairs of different components whose sizes allow the similarity and whose estimate,
corrected for chance matches of registers, is within ``SLACK`` deviations of it, each in the first band
that the two share. No pair is a row: a task gives its likely pairs in packets of nodes whose sets hold
about ``PACKET`` shingles a side, and the full sets, read again from the texts, meet packet by packet. A
packet gives a forest of its links.

At a similarity of 0.8 a link escapes all 64 bands with a probability below 1e-5, at 0.85 below 1e-8.

Defined results: null and empty texts and texts without words have an empty set and link with nothing;
a text shorter than a shingle is one shingle; rows repeated under one id are rows of their own, and
null ids are never the name of a component that has another; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, forget
from .components import components
from .words import byte_texts, chunks, hash_texts, mix

REGISTERS, MANTISSA, BAND = 512, 10, 8
BANDS = REGISTERS // BAND
_REST = 55  # bits of a hash below those that choose the bucket
LEADERS = (0, 0x5DEECE66D1234567)  # one for each round with leaders: a group's leader is its least node in the order this gives
BLOCK, TESTED = 2048, 1 << 13  # nodes of a side of a block, pairs estimated at once
SLACK = 4.5
PACKET = 1 << 20  # shingles of a side of a packet; a longer set makes a side of its own
_RANK = np.random.default_rng(7).permuted(np.tile(np.arange(REGISTERS, dtype=np.int16), (REGISTERS, 1)), axis=1)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words, or of the whole if there are fewer."""
    if not len(words):
        return words
    span = min(size, len(words))
    total = np.full(len(words) - span + 1, span, np.uint64)
    for i in range(span):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - span + 1 + i], 4)
    return np.unique(total)


def registers(hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """Registers (uint16) of a sorted non-empty set, and how many buckets it fills."""
    edges = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(_REST)
    first = np.searchsorted(hashes, edges)
    filled = np.diff(np.append(first, len(hashes))) > 0
    rest = hashes[np.minimum(first, len(hashes) - 1)] & np.uint64((1 << _REST) - 1)
    rest = np.maximum(rest & ~np.uint64(7), np.uint64(8))  # 52 bits, exact as a double
    zeros = (_REST - np.frexp(rest.astype(np.float64))[1]).astype(np.uint64)
    bits = ((rest << (zeros + np.uint64(1))) & np.uint64((1 << _REST) - 1)) >> np.uint64(_REST - MANTISSA)
    values = ((zeros << np.uint64(MANTISSA)) | bits).astype(np.uint16)
    full, empty = np.flatnonzero(filled), np.flatnonzero(~filled)
    if len(empty):
        values[empty] = values[full[_RANK[np.ix_(empty, full)].argmin(axis=1)]]
    return values, len(full)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key for each row of registers and band."""
    packed = np.ascontiguousarray(sketches).view(np.uint64).reshape(len(sketches), BANDS, BAND // 4)
    keys = mix(np.arange(BANDS, dtype=np.uint64), 15)
    for i in range(BAND // 4):
        keys = mix(keys + packed[:, :, i], 16 + i)
    return keys


def estimate(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Jaccard estimate of rows of registers, without the matches that two different values make by chance."""
    ratio = sizes / others
    chance = 0.169919487159739 * REGISTERS / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return np.clip(((left == right).sum(axis=1) - chance) / REGISTERS, 0, 1)


def _sets(docs: DataFrame, size: int, with_sketch: bool) -> DataFrame:
    """(id, node, n, filled, sketch) or (node, shingles) of all rows (id, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            texts = byte_texts(batch.column(1))
            for a, b in chunks(texts):
                words, bounds = hash_texts(texts[a:b])
                sets = [shingles(words[bounds[i] : bounds[i + 1]], size) for i in range(b - a)]
                node = pa.array([int(mix(s, 5).sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64())
                if with_sketch:
                    made = [registers(s) if len(s) else (np.empty(0, np.uint16), 0) for s in sets]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a, b - a), node, pa.array([len(s) for s in sets], pa.int64()),
                         pa.array([m[1] for m in made], pa.int32()), pa.array([m[0].tobytes() for m in made], pa.binary())],
                        names=["id", "node", "n", "filled", "sketch"],
                    )
                else:
                    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                    flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [node, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["node", "shingles"]
                    )

    schema = f"id {kind}, node long, n long, filled int, sketch binary" if with_sketch else "node long, shingles array<long>"
    return docs.mapInArrow(work, schema)


def _grouped(nodes: DataFrame) -> DataFrame:
    """(band, node) of nodes that share a band with another node."""

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                sketches = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                keys = band_keys(sketches).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], names=["band", "node"]
                )

    banded = nodes.select("node", "sketch").mapInArrow(work, "band long, node long")
    shared = banded.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("band")
    return banded.join(shared, "band")


def _passes(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, filled: np.ndarray, least: int) -> np.ndarray:
    """Which pairs of rows of registers allow a similarity of ``least`` percent."""
    goal = least / 100
    deviation = np.sqrt(goal * (1 - goal) * (1 / filled + 1 / REGISTERS))
    return estimate(left, right, n_left, n_right) >= goal - SLACK * deviation


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _likely(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) whose registers allow a similarity of ``least`` percent."""
    side = lambda x: nodes.select(*[F.col(c).alias(f"{c}_{x}") for c in ("node", "filled", "sketch")])
    both = (
        pairs.join(side("a"), F.col("a") == F.col("node_a")).join(side("b"), F.col("b") == F.col("node_b"))
        .select("a", "b", "n_a", "n_b", F.least("filled_a", "filled_b").alias("filled"), "sketch_a", "sketch_b")
    )

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                n_a, n_b, filled = (batch.column(i).to_numpy() for i in (2, 3, 4))
                good = _passes(_sketches(batch.column(5)), _sketches(batch.column(6)), n_a, n_b, filled, least)
                yield batch.select(["a", "b", "n_a", "n_b"]).filter(pa.array(good))

    return both.mapInArrow(work, "a long, b long, n_a long, n_b long")


def _led(groups: DataFrame, info: DataFrame, order: int, least: int) -> DataFrame:
    """(a, b, n_a, n_b): each node with the leader of another component that it shares most groups with."""
    leader = groups.groupBy("band").agg(F.min(F.col("node").bitwiseXOR(F.lit(order))).alias("x"))
    leader = leader.select("band", F.col("x").bitwiseXOR(F.lit(order)).alias("leader"))
    shared = groups.join(leader, "band").where("node <> leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("bands"))
    chief = info.select(F.col("node").alias("leader"), F.col("n").alias("n_b"), F.col("component").alias("apart"))
    apart = (
        shared.join(info, "node").join(chief, "leader")
        .where((F.col("component") != F.col("apart")) & (100 * F.least("n", "n_b") >= least * F.greatest("n", "n_b")))
    )
    best = apart.groupBy("node").agg(F.max(F.struct("bands", "leader", "n", "n_b")).alias("best"))
    return best.select(F.col("node").alias("a"), F.col("best.leader").alias("b"), F.col("best.n").alias("n_a"), F.col("best.n_b").alias("n_b"))


def _compare(least: int):
    """Rows of one (band, low, high) follow each other; gives the likely pairs of each block in packets."""

    def tests(rows: pa.RecordBatch):
        """The places of pairs of different components whose sizes allow the similarity."""
        side, component, n = (rows.column(i).to_numpy() for i in (4, 5, 6))
        one_block = rows.column(1)[0].as_py() == rows.column(2)[0].as_py()
        by_size = np.argsort(n, kind="stable")
        far = np.searchsorted(n[by_size], 100 * n[by_size] // least, side="right")
        lefts, rights, held = [], [], 0
        for at in range(len(n)):
            i, others = by_size[at], by_size[at + 1 : far[at]]
            others = others[component[others] != component[i]]
            if not one_block:
                others = others[side[others] != side[i]]
            for start in range(0, len(others), TESTED):
                lefts.append(np.full(len(others[start : start + TESTED]), i))
                rights.append(others[start : start + TESTED])
                held += len(rights[-1])
                if held >= TESTED:
                    yield np.concatenate(lefts), np.concatenate(rights)
                    lefts, rights, held = [], [], 0
        if held:
            yield np.concatenate(lefts), np.concatenate(rights)

    def group(rows: pa.RecordBatch):
        node, n, filled = (rows.column(i).to_numpy() for i in (3, 6, 7))
        sketches = _sketches(rows.column(8))
        keys = band_keys(sketches)
        turn = int(np.flatnonzero(keys[0] == np.uint64(rows.column(0)[0].as_py() & (1 << 64) - 1))[0])
        found = []
        for a, b in tests(rows):
            good = _passes(sketches[a], sketches[b], n[a], n[b], np.minimum(filled[a], filled[b]), least)
            a, b = a[good], b[good]
            new = ~(keys[a, :turn] == keys[b, :turn]).any(axis=1)
            found.append(np.stack([a[new], b[new]], axis=1))
        pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        if not len(pairs):
            return
        used = np.unique(pairs)
        used = used[np.argsort(n[used], kind="stable")]
        tile = np.empty(len(n), np.int64)
        tile[used] = (np.cumsum(n[used]) - n[used]) // PACKET
        part = tile[pairs[:, 0]] * (tile[used[-1]] + 1) + tile[pairs[:, 1]]
        pairs = pairs[np.argsort(part, kind="stable")]
        for k, own in enumerate(np.split(pairs, np.cumsum(np.unique(part, return_counts=True)[1])[:-1])):
            inside, places = np.unique(own, return_inverse=True)
            marks = [rows.column(i).slice(0, 1) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*marks, pa.array([k], pa.int32()), pa.array([node[inside]], pa.list_(pa.int64())),
                 pa.array([places.reshape(-1, 2).astype(np.int32).tobytes()], pa.binary())],
                names=["band", "low", "high", "part", "nodes", "pairs"],
            )

    return lambda batches: _by_key(batches, 3, group)


def _blocks(groups: DataFrame, nodes: DataFrame, info: DataFrame, least: int) -> DataFrame:
    """Packets of the likely pairs of different components, each once, of all groups that hold two components."""
    here = groups.join(info.select("node", "component"), "node")
    split = (
        here.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("rows"))
        .where("low < high").select("band", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    )
    side = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        here.join(split, "band").withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("band", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "node", "side", "component")
    )
    rich = dealt.join(nodes.select("node", "n", "filled", "sketch"), "node").select(
        "band", "low", "high", "node", "side", "component", "n", "filled", "sketch"
    )
    ordered = rich.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    return ordered.mapInArrow(_compare(least), "band long, low int, high int, part int, nodes array<long>, pairs binary")


def _by_key(batches, keys: int, work):
    """Hands on all rows that agree in the first columns at once; such rows follow each other."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        marks = np.stack([batch.column(i).to_numpy() for i in range(keys)])
        starts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist()]
        for start, end in zip(starts[:-1], starts[1:]):
            yield from work(batch.slice(start, end - start))
        rest = batch.slice(starts[-1])
    if rest is not None:
        yield from work(rest)


def _forest(least: int):
    """The head of a packet (its pairs) and the sets of its nodes; gives links that join what all its links join."""

    def packet(rows: pa.RecordBatch):
        pairs = np.frombuffer(rows.column(7)[0].as_py(), np.int32).reshape(-1, 2)
        rows = rows.slice(1)
        node, sets = rows.column(5).to_numpy(), rows.column(6)
        size = sets.value_lengths().to_numpy().astype(np.int64)
        start = np.cumsum(size) - size
        held = np.unique(sets.flatten().to_numpy(), return_inverse=True)[1]
        inside, root, links = np.zeros(len(held) + 1, bool), np.arange(len(node)), []
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        firsts, counts = np.unique(pairs[:, 0], return_counts=True)
        for a, others in zip(firsts.tolist(), np.split(pairs[:, 1], np.cumsum(counts)[:-1])):
            others = others[root[others] != root[a]]
            if not len(others):
                continue
            own = held[start[a] : start[a] + size[a]]
            inside[own] = True
            met = inside[np.concatenate([held[start[b] : start[b] + size[b]] for b in others])]
            shared = np.add.reduceat(met.astype(np.int64), np.cumsum(size[others]) - size[others])
            inside[own] = False
            for b in others[100 * shared >= least * (size[a] + size[others] - shared)].tolist():
                if root[b] != root[a]:
                    links.append((a, b))
                    root[root == root[b]] = root[a]
        if links:
            a, b = node[np.array(links)].T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return lambda batches: _by_key(batches, 4, packet)


def _held(asked: DataFrame, docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the nodes asked for, made from the texts of their documents; a stored table."""
    ids = nodes.join(asked, "node").select(F.col("id").alias("of")).distinct()
    held = _sets(docs.join(ids, F.col("id").eqNullSafe(F.col("of")), "left_semi").select("id", "text"), size, False)
    return cut_lineage(held.join(asked, "node", "left_semi").dropDuplicates(["node"]))


def _confirmed_in_packets(packets: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, least: int) -> DataFrame:
    """Links (a, b) that join all that the pairs of ``packets`` with the similarity join."""
    held = _held(packets.select(F.explode("nodes").alias("node")).distinct(), docs, nodes, size)
    key = ["band", "low", "high", "part"]
    heads = packets.select(
        *key, F.lit(-1).alias("place"), F.lit(None).cast("long").alias("node"), F.lit(None).cast("array<long>").alias("shingles"), "pairs"
    )
    members = packets.select(*key, F.posexplode("nodes").alias("place", "node")).join(held, "node").select(
        *key, "place", "node", "shingles", F.lit(None).cast("binary").alias("pairs")
    )
    ordered = heads.unionByName(members).repartition(*key).sortWithinPartitions(*key, "place")
    links = cut_lineage(ordered.mapInArrow(_forest(least), "a long, b long"))
    forget(held)
    return links


def _confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, least: int) -> DataFrame:
    """The pairs whose full sets have the similarity; sets are made from the texts of the nodes' documents."""
    held = _held(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), docs, nodes, size)
    joined = (
        pairs.join(held.withColumnRenamed("shingles", "set_b"), F.col("b") == F.col("node")).drop("node")
        .join(held.withColumnRenamed("shingles", "set_a"), F.col("a") == F.col("node"))
    )
    shared = F.size(F.array_intersect("set_a", "set_b"))
    links = cut_lineage(joined.where(100 * shared >= least * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b"))
    forget(held)
    return links


def near_duplicates(
    docs: DataFrame, words: int = 5, least: int = 80, identifier: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row: links join sets with at least ``least`` percent in common."""
    docs = docs.select(F.col(identifier).alias("id"), F.col(text).alias("text"))
    made = cut_lineage(_sets(docs, words, True))
    full = made.where("n > 0")
    firsts = full.groupBy("node").agg(F.min("id").alias("first"))
    named = cut_lineage(firsts)
    nodes = cut_lineage(
        full.join(named.withColumnRenamed("node", "of"), (F.col("node") == F.col("of")) & F.col("id").eqNullSafe(F.col("first")))
        .select("node", "id", "n", "filled", "sketch").dropDuplicates(["node"])
    )
    groups = cut_lineage(_grouped(nodes))
    links, labels, spent = None, None, []
    for order in (*LEADERS, None):
        known = nodes.select("node", "n")
        if labels is None:
            info = known.withColumn("component", F.col("node"))
        else:
            info = known.join(labels, "node", "left").select("node", "n", F.coalesce("component", "node").alias("component"))
        if order is None:
            pairs, likely = None, cut_lineage(_blocks(groups, nodes, info, least))
            found = _confirmed_in_packets(likely, docs, nodes, words, least)
        else:
            pairs = cut_lineage(_led(groups, info, order, least))
            likely = cut_lineage(_likely(pairs, nodes, least))
            found = _confirmed(likely, docs, nodes, words, least)
        spent.append(found)
        links = found if links is None else links.unionByName(found)
        before, labels = labels, components(links)
        for frame in (pairs, likely, before):
            if frame is not None:
                forget(frame)
    classes = named.join(labels, "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    least_id = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = cut_lineage(classes.join(least_id, "component").select(F.col("node").alias("of"), "component_id"))
    result = cut_lineage(
        made.join(classes, (F.col("node") == F.col("of")) & (F.col("n") > 0), "left").select(
            F.col("id").alias(identifier), F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        )
    )
    for frame in (made, named, nodes, groups, labels, classes, *spent):
        forget(frame)
    return result.withColumn("kept", F.col(identifier).eqNullSafe(F.col("component_id")))


def row_key(identifier: str, text: str) -> Column:
    """Names rows equal in id and text; ordered by id, null ids last."""
    return F.struct(
        F.col(identifier).isNull().alias("unnamed"), F.col(identifier).alias("id"), F.coalesce(F.md5(F.col(text)), F.lit("")).alias("text")
    )


def deduplicated(docs: DataFrame, words: int = 5, least: int = 80, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, all columns kept; of rows equal in id and text, one.

    Decided by row: null and repeated ids name no group."""
    key, gone = "_row", "_gone"
    while {key, gone} & set(docs.columns):
        key, gone = f"_{key}", f"_{gone}"
    keyed = docs.withColumn(key, row_key(identifier, text))
    verdict = near_duplicates(keyed, words, least, key, text)
    marked = verdict.groupBy(F.col(key).alias("_of")).agg(
        F.bool_and("kept").alias("_kept"), (F.count(F.lit(1)) > 1).alias(gone)
    ).where(~F.col("_kept") | F.col(gone)).select("_of", F.when(~F.col("_kept"), True).otherwise(False).alias(gone))
    judged = keyed.join(marked, F.col(key).eqNullSafe(F.col("_of")), "left")
    single = judged.where(F.col(gone).isNull())
    repeated = judged.where(~F.col(gone)).dropDuplicates([identifier, text])
    return single.unionByName(repeated).select(*docs.columns)
