"""Near-duplicate vectors through an index of pivot permutations.

Reference points (pivots) are drawn from the vectors; the sample that they come from is
bounded, all vectors are indexed. A vector is described by its nearest pivots in order.
It is posted in one inverted list for each pair among its first PREFIX pivots, so a list
holds the vectors that share at least two of them. The vectors of a list are compared in
blocks of bounded size, every block with every other, so lists of any length come out
whole. A pair is counted in the first list that it shares only. What leaves a comparison
is one row for each vector with links: how many it found, and the smallest vector it is
connected to there; pairs are never written out.

Cosines are taken in double precision. Vectors that are null, empty, zero, or that hold
null or non-finite components have no links; vectors of different lengths have none
with each other. Equal vectors are indexed once and count with their number. Repeated
rows are vectors of their own. A row with a null vec_id has no links and a null
component_id. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import components, map_batches, map_groups, stored

#: Reference points, each vector's nearest ones that count, and vectors compared at a time.
PIVOTS, PREFIX, BLOCK = 256, 6, 1024
#: Vectors that the pivots are chosen from, and the cosine that pivots stay below.
SAMPLE, APART = 2048, 0.7
_PAIRS = list(combinations(range(PREFIX), 2))


def unit(values: list | None) -> np.ndarray | None:
    """The vector at length one, or None if it cannot link."""
    if not values or None in values:
        return None
    vector = np.array(values, np.float64) + 0.0
    top = np.abs(vector).max()
    if not np.isfinite(top) or top == 0:
        return None
    vector = vector / top
    return vector / np.sqrt((vector * vector).sum())


def _read(vectors: DataFrame) -> DataFrame:
    """vec_id, and for vectors that can link their key, length and unit vector."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                found = [unit(values) for values in part.column(1).to_pylist()]
                packed = [None if v is None else v.tobytes() for v in found]
                keys = [None if p is None else xxhash.xxh3_128_digest(p) for p in packed]
                sizes = [None if v is None else len(v) for v in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(keys, pa.binary()),
                        pa.array(sizes, pa.int32()),
                        pa.array(packed, pa.binary()),
                    ],
                    ["vec_id", "key", "dims", "unit"],
                )

    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    return map_batches(rows, read, "vec_id long, key binary, dims int, unit binary")


def spread_pivots(sample: list[np.ndarray]) -> np.ndarray:
    """Up to PIVOTS of the sampled vectors, none close to an earlier one.

    Pivots from one group of near copies would order its vectors by chance. Where there are
    too few, fixed directions make up the number, so that every vector has a prefix.
    """
    wide = max((len(vector) for vector in sample), default=1)
    pivots = np.zeros((PIVOTS, wide))
    n = 0
    for vector in sample:
        padded = np.pad(vector, (0, wide - len(vector)))
        if n < PIVOTS and (n == 0 or (pivots[:n] @ padded).max() < APART):
            pivots[n] = padded
            n += 1
    if n < PIVOTS:
        more = np.random.default_rng(11).standard_normal((PIVOTS - n, wide))
        pivots[n:] = more / np.linalg.norm(more, axis=1, keepdims=True)
    return pivots


def nearest_pivots(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Numbers of the PREFIX nearest pivots of each row, nearest first, ties by number."""
    wide = max(units.shape[1], pivots.shape[1])
    left = np.pad(units, ((0, 0), (0, wide - units.shape[1])))
    right = np.pad(pivots, ((0, 0), (0, wide - pivots.shape[1])))
    return np.argsort(-(left @ right.T).round(12), axis=1, kind="stable")[:, :PREFIX]


def lists_of(nearest: np.ndarray) -> np.ndarray:
    """The inverted lists of each row, sorted: one for each pair among its pivots."""
    pairs = [(nearest[:, i], nearest[:, j]) for i, j in _PAIRS]
    columns = [np.minimum(a, b) * PIVOTS + np.maximum(a, b) for a, b in pairs]
    return np.sort(np.stack(columns, axis=1), axis=1).astype(np.int32)


def _post(distinct: DataFrame, pivots: np.ndarray) -> DataFrame:
    """id, copies, dims, unit, lists: the inverted lists that each vector is posted in."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array(batch.column(2).to_pylist(), np.int64)
            packed = batch.column(3).to_pylist()
            lists: list = [None] * len(packed)
            for size in np.unique(dims):
                at = np.flatnonzero(dims == size)
                units = np.frombuffer(b"".join(packed[i] for i in at)).reshape(len(at), size)
                for i, row in zip(at.tolist(), lists_of(nearest_pivots(units, pivots)).tolist()):
                    lists[i] = row
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists, kind)], [*batch.schema.names, "lists"]
            )

    schema = "id long, copies long, dims int, unit binary, lists array<int>"
    return map_batches(distinct.select("id", "copies", "dims", "unit"), post, schema)


def _labels(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``count`` points the smallest one connected to it."""
    labels = np.arange(count)
    while True:
        lower = labels.copy()
        np.minimum.at(lower, i, labels[j])
        np.minimum.at(lower, j, labels[i])
        lower = lower[lower]
        if (lower == labels).all():
            return labels
        labels = lower


def link_vectors(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of (vec_id, embedding)."""
    read = stored(_read(vectors), "vectors")
    able = F.col("key").isNotNull() & F.col("vec_id").isNotNull()
    distinct = stored(
        read.where(able)
        .groupBy("key", "dims")
        .agg(
            F.min("vec_id").alias("id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("unit").alias("unit"),
        ),
        "distinct-vectors",
    )
    # At most SAMPLE vectors, those with the smallest hashes.
    drawn = distinct.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(SAMPLE).select("unit")
    pivots = spread_pivots([np.frombuffer(row["unit"]) for row in drawn.collect()])
    posted = stored(_post(distinct, pivots), "posted")

    postings = posted.select("id", "dims", F.explode("lists").alias("list"))
    lengths = (
        postings.groupBy("list", "dims")
        .agg(F.count(F.lit(1)).alias("length"))
        .where("length > 1")
        .withColumn("blocks", F.ceil(F.col("length") / BLOCK))
    )
    half = (
        posted.withColumn("list", F.explode("lists"))
        .join(lengths, ["list", "dims"])
        .withColumn("block", F.pmod(F.xxhash64("id", "list"), F.col("blocks")))
        .withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "met"))
        .withColumn("high", F.greatest("block", "met"))
    )

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids = group.column("id").to_numpy()
        copies = group.column("copies").to_numpy()
        size = group.column("dims")[0].as_py()
        units = np.frombuffer(b"".join(group.column("unit").to_pylist())).reshape(-1, size)
        lists = np.array(group.column("lists").to_pylist(), np.int32)
        block = group.column("block").to_numpy()
        here = group.column("list")[0].as_py()
        across = group.column("low")[0].as_py() != group.column("high")[0].as_py()
        left, right = [], []
        for start in range(0, len(ids), 256):
            near = units[start : start + 256] @ units.T >= cosine
            i, j = np.nonzero(near)
            i = i + start
            kept = i < j
            if across:
                kept &= block[i] != block[j]
            i, j = i[kept], j[kept]
            # Only the first list that both are posted in counts the pair.
            shared = (lists[i][:, :, None] == lists[j][:, None, :]).any(axis=2)
            first = lists[i, shared.argmax(axis=1)] == here
            left.append(i[first])
            right.append(j[first])
        i, j = np.concatenate(left), np.concatenate(right)
        links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        found = np.flatnonzero(links)
        return pa.table(
            {
                "id": ids[found],
                "links": links[found].astype(np.int64),
                "root": ids[_labels(len(ids), i, j)][found],
            }
        )

    columns = ("list", "dims", "low", "high", "id", "copies", "unit", "lists", "block")
    keys = ["list", "dims", "low", "high"]
    partial = stored(
        map_groups(half.select(*columns), keys, compare, "id long, links long, root long"), "links"
    )
    counted = partial.groupBy("id").agg(F.sum("links").alias("links"))
    classes = components(partial.select(F.col("id").alias("a"), F.col("root").alias("b")))
    of_vector = (
        distinct.select("key", "dims", "id", "copies")
        .join(counted, "id", "left")
        .join(classes, "id", "left")
        .select(
            "key",
            "dims",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )
    linked = F.col("vec_id").isNotNull()
    return (
        read.drop("unit")
        .join(of_vector, ["key", "dims"], "left")
        .select(
            "vec_id",
            F.when(linked, F.coalesce("links", F.lit(0))).otherwise(0).alias("n_links"),
            F.when(linked, F.coalesce("component_id", "vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
