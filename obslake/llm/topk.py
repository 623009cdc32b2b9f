"""Exact top-k search by inner product over vector-approximation files.

Each component of a vector is replaced by the number of the cell that it falls in, one byte
instead of a whole number; that is the approximation file. What is known of a vector from
its cells bounds its inner product with a query from below and from above.

1. The cells are scanned for bounds. The k-th highest lower bound of a query is a score that
   it reaches in any case.
2. The cells are scanned again. A vector whose upper bound does not reach that score is out.
   The exact vectors of the others are read in the order of their bounds (highest first),
   until no bound that is left can change the k results.

Vectors are dealt to runs of bounded size by their keys. Queries, in tiles, meet every run:
a task holds one run and streams the tiles through it, so what it holds does not grow with
the table, and what it puts out is at most k rows for each query and run. Equal vectors are
one entry with its smallest ids, and equal queries are searched once, so copies cost nothing.

Scores are whole numbers, and exact. Ties go to the smaller vec_id; rows that share a vec_id
are candidates of their own, but a query's own row is not. Vectors of different lengths are
not compared. Rows take no part if vec_id is null or the vector is null or empty, holds a
null or non-finite component or one beyond 2**28 after scaling, or has a squared length
beyond 2**60 (scores would not fit a long). Extra columns are ignored; no rows, no results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obslake.llm.common import map_batches, stored
from obslake.llm.integers import cells_of, grid, matrix, products, read_whole

#: Cells that a component is told apart by.
CELLS = 64
#: Components in a run, in a tile of queries, and queries that are searched at a time.
RUN, TILE, TOGETHER = 2**18, 2**12, 512
#: Exact vectors that are read at a time, at first.
READ = 64
#: Largest squared length for which every score fits a long.
LONGEST = 2**60

_QUERY = "array<struct<key:binary,v:binary,floor:double,floor_id:long>>"


def bounds(
    queries: np.ndarray, cells: np.ndarray, edges: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest score that each query can have with each row of cells.

    A cell's middle gives the score, half its width what may be missing on either side;
    both are doubled here to be whole, which keeps the bounds exact up to 2**52. Beyond, they
    are widened by what rounding may lose.
    """
    lowest, highest = edges[:-1][cells], edges[1:][cells] - 1
    middle = queries @ (lowest + highest).astype(np.float64).T
    missing = np.abs(queries) @ (highest - lowest).astype(np.float64).T
    size = np.abs(queries).sum(axis=1, keepdims=True) * 2.0 * np.abs(edges).max()
    missing += np.where(size < 2**52, 0.0, size * (queries.shape[1] + 2) * 2.0**-50)
    return (middle - missing) / 2, (middle + missing) / 2


def best_lower(lower: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The columns of the k highest values of each row, ties to the smaller id."""
    n = lower.shape[1]
    k = min(k, n)
    least = np.partition(lower, n - k, axis=1)[:, n - k]
    picked = []
    for row, edge in zip(lower, least):
        above = np.flatnonzero(row > edge)
        tied = np.flatnonzero(row == edge)[: k - len(above)]
        picked.append(np.concatenate([above, tied]))
    return np.array(picked)


def search(
    query: np.ndarray,
    upper: np.ndarray,
    floor: float,
    floor_id: int,
    ids: np.ndarray,
    exact: np.ndarray,
    k: int,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions and scores of the query's k best rows that reach its floor, and how many
    exact vectors were read for it. Rows are in the order of their ids."""
    able = np.flatnonzero((upper > floor) | ((upper == floor) & (ids <= floor_id)))
    order = able[np.lexsort((able, -upper[able]))]
    at = np.zeros(0, np.int64)
    scores = np.zeros(0, np.int64)
    read, step = 0, READ
    while read < len(order):
        if len(at) == k:
            # In this order no later row can get in if the next one cannot.
            following, last = order[read], scores[-1]
            if (-upper[following], following) > (-last, at[-1]):
                break
        chosen = order[read : read + step]
        read += len(chosen)
        step *= 2
        at = np.concatenate([at, chosen])
        scores = np.concatenate([scores, products(query[None, :], exact[chosen])[0]])
        ranked = np.lexsort((at, -scores))[:k]
        at, scores = at[ranked], scores[ranked]
    return at, scores, read


class _Run:
    """The vectors of one run, in the order of their ids."""

    def __init__(self, rows: list[tuple], dims: int, edges: np.ndarray):
        rows.sort(key=lambda row: (row[1], row[0]))
        self.edges = edges
        self.keys = [row[0] for row in rows]
        self.ids = np.array([row[1] for row in rows], np.int64)
        self.cells = np.frombuffer(b"".join(row[2] for row in rows), np.uint8).reshape(-1, dims)
        whole = [row[3] for row in rows]
        self.exact = None if None in whole else matrix(whole, dims)


def _streamed(
    batches: Iterator[pa.RecordBatch], edges: np.ndarray
) -> Iterator[tuple[int, _Run, list[dict]]]:
    """Each run with the queries that meet it, some at a time."""
    at, rows, run = None, [], None
    for batch in batches:
        dims, runs, kinds = (batch.column(c).to_pylist() for c in (0, 1, 2))
        entries = list(zip(*(batch.column(c).to_pylist() for c in (3, 4, 5, 6))))
        waiting: list[dict] = []
        for i in range(batch.num_rows):
            if (dims[i], runs[i]) != at:
                if waiting and run:
                    yield at[0], run, waiting
                at, rows, run, waiting = (dims[i], runs[i]), [], None, []
            if kinds[i] == 0:
                rows.append(entries[i])
                continue
            if run is None and rows:
                run, rows = _Run(rows, dims[i], edges), []
            if run is not None:
                waiting += batch.column(7)[i].as_py()
                while len(waiting) >= TOGETHER:
                    yield dims[i], run, waiting[:TOGETHER]
                    waiting = waiting[TOGETHER:]
        if waiting and run:
            yield at[0], run, waiting


def _first(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key; tasks drop what cannot be among them before the shuffle."""
    number = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("number", number).where(F.col("number") <= k)


def _entries(read: DataFrame, k: int) -> DataFrame:
    """dims, key, v and the k smallest ids of each distinct vector."""
    first = _first(read, ["dims", "key"], [F.col("vec_id").asc()], k)
    return first.groupBy("dims", "key").agg(
        F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids")
    )


def _approximated(entries: DataFrame, edges: np.ndarray, runs: int) -> DataFrame:
    """The approximation file, with the exact vectors in a column of their own."""

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [
                cells_of(np.frombuffer(v, "<i4"), edges).astype(np.uint8).tobytes()
                for v in batch.column("v").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.binary())], [*batch.schema.names, "cells"]
            )

    dealt = entries.select(
        "dims",
        "key",
        F.col("ids")[0].alias("id"),
        "v",
        F.pmod(F.xxhash64("key"), F.lit(runs)).cast("int").alias("run"),
    )
    schema = "dims int, key binary, id long, v binary, run int, cells binary"
    return stored(map_batches(dealt, approximate, schema), "approximation")


def _met(file: DataFrame, tiles: DataFrame, runs: int, exact: bool) -> DataFrame:
    """The rows of each run, followed by all tiles of queries, in one partition for each run."""
    kind = F.lit(0).alias("kind")
    v = (F.col("v") if exact else F.lit(None).cast("binary")).alias("v")
    nothing = F.lit(None).cast(_QUERY).alias("queries")
    entries = file.select("dims", "run", kind, "key", "id", "cells", v, nothing)
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("key", "binary"), ("id", "long"))]
    none += [F.lit(None).cast("binary").alias(n) for n in ("cells", "v")]
    visits = tiles.select(
        "dims", everywhere, F.lit(1).alias("kind"), *none, F.col("queries").cast(_QUERY)
    )
    return (
        entries.unionAll(visits.select(*entries.columns))
        .repartitionById(runs, "run")
        .sortWithinPartitions("dims", "run", "kind")
    )


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64, cells: int = CELLS
) -> DataFrame:
    """query_id, rank, vec_id and score: the k best other rows of (vec_id, embedding) for
    each row that ``is_query`` (over vec_id) names."""
    read = read_whole(vectors, scale).where(
        F.col("vec_id").isNotNull() & (F.col("squares") <= LONGEST)
    )
    most = read.agg(F.max("dims")).first()[0] or 1
    # One more than asked for, since a query's own row may be among the best.
    wanted = k + 1
    entries = stored(_entries(read, wanted), "entries")
    runs = max(1, math.ceil(entries.count() * most / RUN))
    edges = grid(read, cells)
    file = _approximated(entries, edges, runs)

    asked = read.where(is_query).select("vec_id", "dims", "key", "v")
    distinct = stored(
        asked.groupBy("dims", "key").agg(F.first("v").alias("v")), "distinct-queries"
    )
    per_tile = max(1, TILE // most)
    n_tiles = max(1, math.ceil(distinct.count() / per_tile))

    def tiles(queries: DataFrame) -> DataFrame:
        tile = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(n_tiles)).alias("tile")
        query = F.struct("key", "v", "floor", "floor_id")
        grouped = queries.groupBy("dims", tile).agg(F.collect_list(query).alias("queries"))
        return grouped.select("dims", "queries")

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, run, queries in _streamed(batches, edges):
            lower, _ = bounds(matrix([q["v"] for q in queries], dims), run.cells, edges)
            best = best_lower(lower, run.ids, wanted)
            n = best.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([dims] * (len(queries) * n), pa.int32()),
                    pa.array([q["key"] for q in queries for _ in range(n)], pa.binary()),
                    pa.array(np.take_along_axis(lower, best, axis=1).ravel(), pa.float64()),
                    pa.array(run.ids[best].ravel(), pa.int64()),
                ],
                ["dims", "key", "lower", "id"],
            )

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, run, queries in _streamed(batches, edges):
            rows = matrix([q["v"] for q in queries], dims)
            _, upper = bounds(rows, run.cells, edges)
            found: list[list] = [[], [], [], []]
            for q, row, above in zip(queries, rows, upper):
                floor = -math.inf if q["floor"] is None else q["floor"]
                at, scores, _ = search(
                    row, above, floor, q["floor_id"] or 0, run.ids, run.exact, wanted
                )
                found[0] += [q["key"]] * len(at)
                found[1] += [run.keys[i] for i in at]
                found[2] += run.ids[at].tolist()
                found[3] += scores.tolist()
            kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            columns = [pa.array([dims] * len(found[0]), pa.int32())]
            columns += [pa.array(column, kind) for column, kind in zip(found, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["dims", "key", "found", "id", "score"])

    no_floor = {"floor": F.lit(None).cast("double"), "floor_id": F.lit(None).cast("long")}
    first = map_batches(
        _met(file, tiles(distinct.withColumns(no_floor)), runs, exact=False),
        floors,
        "dims int, key binary, lower double, id long",
    )
    lowest = _first(first, ["dims", "key"], [F.col("lower").desc(), F.col("id").asc()], wanted)
    # Fewer than k lower bounds are no floor.
    floor = lowest.where(F.col("number") == wanted).select(
        "dims", "key", F.col("lower").alias("floor"), F.col("id").alias("floor_id")
    )
    floored = stored(distinct.join(floor, ["dims", "key"], "left"), "floors")
    second = map_batches(
        _met(file, tiles(floored), runs, exact=True),
        results,
        "dims int, key binary, found binary, id long, score long",
    )
    order = [F.col("score").desc(), F.col("id").asc(), F.col("found").asc()]
    best = _first(second, ["dims", "key"], order, wanted).drop("number", "id")
    # An entry stands for all its copies, whose smallest ids are all that can count.
    ids = entries.select("dims", F.col("key").alias("found"), F.explode("ids").alias("vec_id"))
    rows = best.join(ids, ["dims", "found"])
    order = [F.col("score").desc(), F.col("vec_id").asc(), F.col("found").asc()]
    ranked = _first(rows, ["dims", "key"], order, wanted)
    own = (F.col("found") == F.col("key")).alias("own")
    lists = stored(
        ranked.groupBy("dims", "key").agg(
            F.sort_array(F.collect_list(F.struct("number", "vec_id", "score", own))).alias("best")
        ),
        "results",
    )
    itself = F.transform("best", lambda x: x["own"] & (x["vec_id"] == F.col("query_id")))
    others = F.filter("best", lambda x, i: i + 1 != F.col("itself"))
    return (
        asked.select(F.col("vec_id").alias("query_id"), "dims", "key")
        .join(lists, ["dims", "key"])
        .withColumn("itself", F.array_position(itself, True))
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "other"))
        .select(
            "query_id",
            (F.col("place") + 1).alias("rank"),
            F.col("other.vec_id").alias("vec_id"),
            F.col("other.score").alias("score"),
        )
    )
