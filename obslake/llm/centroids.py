"""Centroid clustering of vectors over zone maps in the order of a Hilbert curve.

Vectors are put in the order of a Hilbert curve through all their components, which is cut
into blocks of bounded size. A block carries the box around its vectors: the smallest and
the largest value of each component. Distances from the box tell which centroids can be the
nearest of any vector in it:

- a centroid whose least distance from the box is above the greatest distance of another
  one is nobody's nearest;
- nor is one that the box's best centroid beats in every corner. The difference of two
  squared distances is linear, so its extreme over the box is a sum over the components.

Only the candidates are then compared, exactly and for all vectors of the block at once.
Rounds shuffle one partial sum for each task, centroid and component; vectors stay where
they are. The driver holds the centroids and no vector but the first ones.

All arithmetic is in whole numbers. Vectors that do not have the given number of components,
or hold a null, a non-finite one or one beyond 2**27 after scaling (distances would not fit
a long) have no row. Ties go to the smaller centroid. Rows repeated count as often as they
are there; a row with a null vec_id is clustered, but does not start a centroid. If there
are fewer vectors than centroids, each vector starts one. Extra columns are ignored; no
vectors, no rows. Sums that do not fit a long are null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import map_batches, stored
from obslake.llm.integers import cells_of, grid, matrix, products, read_whole

#: Vectors in a block, and blocks that a task makes.
BLOCK, BLOCKS = 256, 64
#: Bits of each component on the curve.
BITS = 4
#: Largest component for which all squared distances fit a long.
WIDEST = 2**27

_BLOCKS = "ids array<long>, v binary, low binary, high binary"


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """The place of each row of cells (below 2**bits) on a Hilbert curve, as sortable bytes.

    The curve's rotations and reflections are undone from the highest bit down, then the
    Gray code; the bits are read out level by level, one of each component.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for i in range(n):
            has = (x[i] & level) != 0
            x[0] = np.where(has, x[0] ^ below, x[0])
            swapped = np.where(has, 0, (x[0] ^ x[i]) & below)
            x[0] ^= swapped
            x[i] ^= swapped
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where((x[n - 1] & level) != 0, turn ^ (level - 1), turn)
        level >>= 1
    x ^= turn
    levels = [(x >> bit) & 1 for bit in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(levels).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def zone_maps(vectors: DataFrame) -> DataFrame:
    """Vectors of one length in blocks along the curve: ids, v, and the box (low, high)."""
    edges = grid(vectors, 1 << BITS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(1).to_pylist()
            if packed:
                values = matrix(packed, len(packed[0]) // 4)
                keys = hilbert_keys(cells_of(values, edges), BITS)
                columns = [*batch.columns, pa.array(keys, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "salt", "curve"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list] = [[], [], [], []]
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                packed = part.column(1).to_pylist()
                values = np.frombuffer(b"".join(packed), "<i4").reshape(len(packed), -1)
                made[0].append(part.column(0).to_pylist())
                made[1].append(b"".join(packed))
                made[2].append(values.min(axis=0).tobytes())
                made[3].append(values.max(axis=0).tobytes())
            kinds = [pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            columns = [pa.array(column, kind) for column, kind in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["ids", "v", "low", "high"])

    # The salt lets any number of equal vectors spread over partitions.
    salted = vectors.select("vec_id", "v", F.xxhash64("vec_id", "key").alias("salt"))
    placed = stored(
        map_batches(salted, place, "vec_id long, v binary, salt long, curve binary"), "curve"
    )
    parts = max(1, math.ceil(placed.count() / (BLOCK * BLOCKS)))
    parts = max(parts, placed.sparkSession.sparkContext.defaultParallelism)
    ordered = placed.repartitionByRange(parts, "curve", "salt")
    along = ordered.sortWithinPartitions("curve", "salt").select("vec_id", "v")
    return stored(map_batches(along, cut, _BLOCKS), "blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be the nearest of a vector in the box, ascending."""
    near = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    least, most = (near * near).sum(axis=1), (far * far).sum(axis=1)
    best = int(most.argmin())
    # The most that d(x, best) - d(x, c) reaches in the box; below zero, c is never nearest.
    gap = centroids[best] - centroids
    norms = (centroids * centroids).sum(axis=1)
    reach = norms[best] - norms - gap @ (low + high) + np.abs(gap) @ (high - low)
    return np.flatnonzero((least <= most[best]) & (reach >= 0))


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, ties to the smaller, and its squared distance."""
    dots = products(values, centroids)
    whole = centroids.astype(np.int64)
    scores = (whole * whole).sum(axis=1) - 2 * dots
    cluster = scores.argmin(axis=1)
    rows = values.astype(np.int64)
    return cluster, scores[np.arange(len(rows)), cluster] + (rows * rows).sum(axis=1)


def _read_block(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low, high = (np.frombuffer(batch.column(c)[i].as_py(), "<i4").astype(np.int64) for c in (2, 3))
    values = np.frombuffer(batch.column(1)[i].as_py(), "<i4").reshape(-1, len(low))
    return values.astype(np.float64), low, high


def assign_block(
    values: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and distance of each vector of a block, and how many candidates it had."""
    able = candidates(low, high, centroids)
    cluster, distance = nearest(values, centroids[able].astype(np.float64))
    return able[cluster], distance, len(able)


def _totals(blocks: DataFrame, centroids: np.ndarray) -> dict[tuple[int, int], int]:
    """(centroid, component) to the sum over its vectors; component -1 counts them and -2
    the comparisons that their blocks needed."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = centroids.shape
        sums, counts, compared = np.zeros((k, size), np.int64), np.zeros(k, np.int64), 0
        for batch in batches:
            for i in range(batch.num_rows):
                values, low, high = _read_block(batch, i)
                cluster, _, able = assign_block(values, low, high, centroids)
                np.add.at(sums, cluster, values.astype(np.int64))
                counts += np.bincount(cluster, minlength=k)
                compared += able * len(values)
        used = np.flatnonzero(counts)
        rows = [(int(c), d, int(sums[c, d])) for c in used for d in range(size)]
        rows += [(int(c), -1, int(counts[c])) for c in used] + [(0, -2, compared)]
        columns = [list(column) for column in zip(*rows)]
        kinds = [pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)],
            ["cluster", "component", "total"],
        )

    partial = map_batches(blocks, add, "cluster int, component int, total long")
    summed = partial.groupBy("cluster", "component").agg(F.sum("total").alias("total"))
    return {(row["cluster"], row["component"]): row["total"] for row in summed.collect()}


def fit(blocks: DataFrame, first: np.ndarray, rounds: int) -> tuple[np.ndarray, list[int]]:
    """The centroids after so many rounds, and the comparisons that each round needed."""
    centroids, compared = first, []
    for _ in range(rounds):
        totals = _totals(blocks, centroids)
        compared.append(totals[0, -2])
        moved = centroids.copy()
        for (c, component), total in totals.items():
            if component >= 0:
                moved[c, component] = total // totals[c, -1]  # rounds down, also below zero
        centroids = moved
    return centroids, compared


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ``seed:vec_id`` has the smallest SHA-256, as rows."""
    named = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    chosen = (
        vectors.where("vec_id is not null")
        .select(F.sha2(named, 256).alias("rank"), "v")
        .orderBy("rank", "v")
        .limit(k)
        .collect()
    )
    rows = [np.frombuffer(row["v"], "<i4").astype(np.int64) for row in chosen]
    return np.array(rows) if rows else np.zeros((0, 0), np.int64)


def assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cluster, distance, _ = assign_block(*_read_block(batch, i), centroids)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i].values,
                        pa.array(cluster, pa.int32()),
                        pa.array(distance, pa.int64()),
                    ],
                    ["vec_id", "cluster", "distance"],
                )

    return map_batches(blocks, step, "vec_id long, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    scale: float = 256,
    size: int = 64,
    seed: int = 2,
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and distance of each vector of (vec_id, embedding), and the centroids."""
    read = read_whole(vectors, scale, size, WIDEST)
    first = first_centroids(read, k, seed)
    if not len(first):
        empty = read.where("false").select(
            "vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")
        )
        return empty, first
    blocks = zone_maps(read)
    centroids, _ = fit(blocks, first, rounds)
    return stored(assign(blocks, centroids), "clusters"), centroids


def with_cluster_facts(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds cluster_inertia, inertia and the digest of each vector's centroid."""
    spark = assigned.sparkSession
    digests = [
        (c, hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest())
        for c, row in enumerate(centroids)
    ]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    # A row for each centroid: small enough for every executor.
    per_cluster = assigned.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    total = per_cluster.agg(F.try_sum("cluster_inertia").alias("inertia"))
    facts = per_cluster.join(F.broadcast(named), "cluster").withColumn("inertia", total.scalar())
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
