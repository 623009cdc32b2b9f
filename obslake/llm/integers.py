"""Vectors as whole numbers: reading, scaling, and a grid of cells over their components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import map_batches, stored

#: Components are kept as 32-bit whole numbers, within this.
WIDEST = 2**28
#: Vectors that the cells of a grid are drawn from.
SAMPLE = 4096

_READ = "vec_id long, key binary, dims int, v binary, low int, high int, squares double"


def whole(values: list | None, scale: float, size: int | None, widest: int) -> np.ndarray | None:
    """floor(scale * x) of each component, or None for a vector that takes no part."""
    if not values or None in values or (size is not None and len(values) != size):
        return None
    vector = np.array(values, np.float64)
    if not np.isfinite(vector).all():
        return None
    vector = np.floor(vector * scale)
    if np.abs(vector).max() > widest:
        return None
    return vector.astype("<i4")


def read_whole(
    vectors: DataFrame, scale: float, size: int | None = None, widest: int = WIDEST
) -> DataFrame:
    """vec_id, key, dims, v, low, high and squares of each vector of (vec_id, embedding) that
    takes part.

    ``v`` holds the components as little-endian 32-bit numbers, ``low`` and ``high`` the
    smallest and the largest, ``squares`` the sum of their squares. Equal vectors have equal keys. Vectors take no part if they
    are null or empty, hold a null or non-finite component or one beyond ``widest``, or do
    not have ``size`` components where that is given.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                found = [whole(v, scale, size, widest) for v in part.column(1).to_pylist()]
                at = [i for i, vector in enumerate(found) if vector is not None]
                kept = [found[i] for i in at]
                packed = [vector.tobytes() for vector in kept]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(at, pa.int64())),
                        pa.array([xxhash.xxh3_128_digest(p) for p in packed], pa.binary()),
                        pa.array([len(vector) for vector in kept], pa.int32()),
                        pa.array(packed, pa.binary()),
                        pa.array([vector.min() for vector in kept], pa.int32()),
                        pa.array([vector.max() for vector in kept], pa.int32()),
                        pa.array([float((v.astype(float) ** 2).sum()) for v in kept], pa.float64()),
                    ],
                    ["vec_id", "key", "dims", "v", "low", "high", "squares"],
                )

    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    return stored(map_batches(rows, read, _READ), "whole-vectors")


def matrix(packed: list[bytes], dims: int) -> np.ndarray:
    """A row of float64 for each packed vector."""
    return np.frombuffer(b"".join(packed), "<i4").reshape(len(packed), dims).astype(np.float64)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of all rows of whole numbers with all others, exactly, as int64.

    The caller sees to it that they fit.
    """
    if left.size == 0 or right.size == 0:
        return np.zeros((len(left), len(right)), np.int64)
    most = np.abs(left).sum(axis=1).max() * np.abs(right).max()
    if most < 2**53:
        return (left @ right.T).astype(np.int64)
    return left.astype(np.int64) @ right.T.astype(np.int64)


def grid(vectors: DataFrame, cells: int) -> np.ndarray:
    """Up to ``cells`` + 1 edges of cells that hold about as many components each.

    Cell i holds the whole numbers from edge i up to but without edge i + 1. The first and
    the last edge come from all vectors, those between from the SAMPLE vectors with the
    smallest keys: they only decide how fine the cells are, not what they hold.
    """
    ends = vectors.agg(F.min("low").alias("low"), F.max("high").alias("high")).first()
    if ends["low"] is None:
        return np.array([0, 1], np.int64)
    drawn = vectors.select("key", "v").orderBy("key").limit(SAMPLE).collect()
    values = np.concatenate([np.frombuffer(row["v"], "<i4") for row in drawn]).astype(np.int64)
    inner = np.quantile(values, np.arange(1, cells) / cells, method="lower")
    edges = np.unique(np.concatenate([[ends["low"]], inner, [ends["high"] + 1]]))
    return edges.astype(np.int64)


def cells_of(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges[1:-1], values, side="right")
