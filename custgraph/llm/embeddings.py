"""Near-duplicate vectors by Euclidean p-stable hashing, then exact cosines.

Normalised vectors are projected on random normal directions; floor((a.x + b) / ``WIDTH``) of
``HASHES`` projections names a bucket in each of ``TABLES`` tables. Vectors of one bucket, label and
length are compared by cosine in double precision, in blocks of about ``BLOCK`` rows a side, and a
pair counts only in the first table in which the two meet. Tasks give sums of links and a forest of
each block, never pairs. At a cosine of 0.98 a link escapes all tables with a probability below 1e-4.

Equal vectors of one label are one node from the start and cost nothing more.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows
without a label, link with nothing and are components of their own; vectors of different lengths do
not link; rows repeated under one id are rows of their own; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, forget
from .components import components

TABLES, HASHES, WIDTH = 40, 10, 1.2
BLOCK = 256


def usable(values) -> bool:
    """Whether a list of numbers can be compared: finite, not null, not all zero."""
    if not values or any(v is None for v in values):
        return False
    array = np.asarray(values, float)
    return bool(np.isfinite(array).all() and array.any())


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def bucket_keys(vectors: np.ndarray, label: str) -> np.ndarray:
    """One 64-bit key of each unit row and table."""
    dim = vectors.shape[1]
    dice = np.random.default_rng([11, dim])
    directions, shift = dice.standard_normal((dim, TABLES * HASHES)), dice.random(TABLES * HASHES) * WIDTH
    cells = np.floor((vectors @ directions + shift) / WIDTH).astype(np.int64).reshape(len(vectors), TABLES, HASHES)
    keys = np.empty((len(vectors), TABLES), np.int64)
    for i in range(len(vectors)):
        for t in range(TABLES):
            digest = hashlib.blake2b(cells[i, t].tobytes() + f"{label}:{t}:{dim}".encode(), digest_size=8)
            keys[i, t] = int.from_bytes(digest.digest(), "little", signed=True)
    return keys


def _nodes(rows: DataFrame) -> DataFrame:
    """(id, node, keys, vector) of rows (id, vector, label); node is null for those that link with nothing."""
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            vectors, labels = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            n = batch.num_rows
            node, packed = [None] * n, [None] * n
            for i, (vector, label) in enumerate(zip(vectors, labels)):
                if label is not None and usable(vector):
                    packed[i] = np.asarray(vector, float).tobytes()
                    node[i] = int.from_bytes(hashlib.blake2b(packed[i] + str(label).encode(), digest_size=8).digest(), "little", signed=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(node, pa.int64()), pa.array([None if x is None else str(x) for x in labels], pa.string()), pa.array(packed, pa.binary())],
                names=["id", "node", "label", "vector"],
            )

    return rows.mapInArrow(work, f"id {kind}, node long, label string, vector binary")


def _keyed(nodes: DataFrame) -> DataFrame:
    """(node, keys, vector) with unit vectors."""

    def work(batches):
        for batch in batches:
            node, labels, packed = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            groups: dict[tuple, list[int]] = {}
            for i, (label, raw) in enumerate(zip(labels, packed)):
                groups.setdefault((label, len(raw)), []).append(i)
            for (label, size), rows in groups.items():
                vectors = unit(np.frombuffer(b"".join(packed[i] for i in rows)).reshape(len(rows), size // 8))
                keys = bucket_keys(vectors, label)
                yield pa.RecordBatch.from_arrays(
                    [node.take(pa.array(rows)), pa.array([k.tobytes() for k in keys], pa.binary()), pa.array([v.tobytes() for v in vectors], pa.binary())],
                    names=["node", "keys", "vector"],
                )

    return nodes.mapInArrow(work, "node long, keys binary, vector binary")


def _buckets(keyed: DataFrame) -> DataFrame:
    def work(batches):
        for batch in batches:
            if batch.num_rows:
                keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(np.tile(np.arange(TABLES, dtype=np.int32), batch.num_rows)), pa.array(np.repeat(batch.column(0).to_numpy(), TABLES))],
                    names=["bucket", "turn", "node"],
                )

    return keyed.select("node", "keys").mapInArrow(work, "bucket long, turn int, node long")


def _compare(least: float):
    """Rows of one (bucket, low, high) follow each other; gives (node, root, links) for each group."""

    def group(rows: pa.RecordBatch):
        node, copies, side = (rows.column(i).to_numpy() for i in (4, 5, 6))
        turn, low, high = int(rows.column(3)[0].as_py()), rows.column(1)[0].as_py(), rows.column(2)[0].as_py()
        vectors = np.frombuffer(b"".join(rows.column(8).to_pylist())).reshape(len(node), -1)
        keys = np.frombuffer(b"".join(rows.column(7).to_pylist()), np.int64).reshape(len(node), -1)
        linked = (vectors @ vectors.T) >= least
        np.fill_diagonal(linked, False)
        if low != high:
            linked &= side[:, None] != side[None, :]
        at, other = np.nonzero(linked)
        if turn:
            new = ~(keys[at, :turn] == keys[other, :turn]).any(axis=1)
            at, other = at[new], other[new]
        links = np.bincount(at, copies[other], minlength=len(node)).astype(np.int64)
        root = np.arange(len(node))
        while True:
            before = root.copy()
            np.minimum.at(root, at, before[other])
            root = root[root]
            if (root == before).all():
                break
        held = links > 0
        return node[held], node[root[held]], links[held]

    def work(batches):
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            marks = np.stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            starts = np.concatenate([[0], cuts])
            yield from results([batch.slice(a, b - a) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())])
            rest = batch.slice(int(starts[-1]))
        if rest is not None and rest.num_rows:
            yield from results([rest])

    def results(groups):
        done = [group(g) for g in groups if g.num_rows > 1]
        if done:
            node, root, links = (np.concatenate(x) for x in zip(*done))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root), pa.array(links)], names=["node", "root", "links"])

    return work


def near_duplicates(
    rows: DataFrame, least: float = 0.98, identifier: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    made = cut_lineage(_nodes(rows.select(F.col(identifier).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))))
    full = made.where("node is not null")
    classes = cut_lineage(full.groupBy("node").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")))
    keyed = cut_lineage(_keyed(full.dropDuplicates(["node"]).select("node", "label", "vector")))
    buckets = cut_lineage(_buckets(keyed))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK)
    here = buckets.join(shared, "bucket").withColumn("blocks", blocks).withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = here.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))).select(
        "bucket", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "turn", "node", "side"
    )
    rich = dealt.join(classes.select("node", "copies"), "node").join(keyed, "node").select(
        "bucket", "low", "high", "turn", "node", "copies", "side", "keys", "vector"
    )
    ordered = rich.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    found = cut_lineage(ordered.mapInArrow(_compare(least), "node long, root long, links long"))
    labels = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(labels, "node", "left").join(sums, "node", "left").select(
        "node", "first", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component")
    )
    least_id = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = cut_lineage(named.join(least_id, "component").select(F.col("node").alias("of"), "copies", "links", "component_id"))
    result = cut_lineage(
        made.join(named, F.col("node") == F.col("of"), "left").select(
            F.col("id").alias(identifier),
            F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).cast("long").alias("component_id"),
        )
    )
    for frame in (made, classes, keyed, buckets, found, labels, named):
        forget(frame)
    return result.withColumn("kept", F.col(identifier).eqNullSafe(F.col("component_id")))
