"""What several text operators share: reading texts in tasks, samples of labels, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obslake.session import ship_package, work_dir

#: Rows turned into Python objects at a time.
SLICE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(modulus)


def held_out(modulus: int, doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from training; rows without an id are, too."""
    return F.coalesce(id_remainder(modulus, doc_id) == 0, F.lit(True))


def as_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 of each text, a null as empty."""
    if isinstance(column, pa.ChunkedArray):
        for chunk in column.chunks:
            yield from as_bytes(chunk)
        return
    raw = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    if not (pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(raw)
    for start in range(0, len(column), SLICE):
        for text in column.slice(start, SLICE).to_pylist():
            yield text or b""


def map_batches(
    frame: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    ship_package(frame.sparkSession)
    return frame.mapInArrow(step, schema)


def map_groups(
    frame: DataFrame, keys: list[str], step: Callable[[pa.Table], pa.Table], schema
) -> DataFrame:
    ship_package(frame.sparkSession)
    return frame.groupBy(*keys).applyInArrow(step, schema)


def with_fields(struct: StructType, ddl: str) -> StructType:
    """A schema with further fields, which may have any type."""
    return StructType([*struct.fields, *StructType.fromDDL(ddl).fields])


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder; its lineage ends there."""
    spark = frame.sparkSession
    path = work_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, modulus: int
) -> tuple[DataFrame, dict[int, float]]:
    """Texts of at most ``per_class`` training rows of each class, and class weights.

    Training rows are those of ``docs`` whose id has a non-zero remainder. The rows with the
    smallest hashes of their ids are taken. The weights restore the shares the
    classes have among all training rows.
    """
    labelled = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        ~held_out(modulus) & F.col("label").isin(0, 1)
    )
    usable = stored(labelled.join(docs.select("doc_id"), "doc_id", "left_semi"), "labels")
    totals = {row["label"]: row["count"] for row in usable.groupBy("label").count().collect()}
    parts = [
        usable.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for value in (0, 1)
    ]
    chosen = parts[0].unionAll(parts[1]).dropDuplicates(["doc_id"])
    weights = {value: n / min(n, per_class) for value, n in totals.items()}
    # At most 2 * per_class ids: small enough for every executor.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts, weights


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id): the smallest id reachable over edges (a, b), for ids with edges.

    Alternates large-star and small-star until the edges are stars. A round joins
    edges to minima, so a hub is never gathered in one task.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct(),
        "edges",
    )
    state = None
    while True:
        seen = now.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).first()
        if seen["n"] == 0 or seen == state:
            break
        state = seen
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(lowest.select("a", F.least("a", "m").alias("m")), "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b")
            .distinct()
        )
        large = stored(large, "large-star")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lowest, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(lowest.select("a", F.col("m").alias("b")))
            .where("a != b")
            .distinct()
        )
        now = stored(small, "small-star")
    roots = now.select(F.col("b").alias("id")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionAll(
        roots.select("id", F.col("id").alias("component_id"))
    )
