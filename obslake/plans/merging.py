"""Few large files in place of many small ones, load by load.

A load's rows are copied, without a shuffle, into a folder of their own beside the table, and when
that is complete, the load's partition is pointed to it. That is one step in the catalog: a
query sees the old files or the new ones, never both and never neither. The old files stay until
the next call, so queries that have begun with them can finish. A copy that was cut short is
not complete, and nobody is pointed to it. If two calls copy a load at the same time, it is pointed
to one of the two copies, which hold the same rows.

Rows, their lineage and the load they belong to stay as they are. Loads at work, and loads
that were stopped, are left alone; writing a load again points back to its own folder. Sessions
that keep a catalog to themselves find the copies when they set it up (``ensure_database``);
let no such session be at work while its files are taken away.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obslake.operators.lineage import utc_stamp
from obslake.plans.claims import ClaimLog
from obslake.plans.lake import (
    Lake,
    Load,
    loads_of,
    merged_copy,
    point_to,
    read_table,
    remove_files,
)
from obslake.plans.ledger import ingest_ledger, is_open
from obslake.plans.store import Store
from obslake.sources.files import list_files

_REPORT = "load_type string, load_dt string, files_before bigint, files_after bigint, n_rows bigint"


def merge_small_files(
    spark: SparkSession, lake: Lake, *, target_bytes: int = 128 << 20, limit: int | None = None
) -> DataFrame:
    """Merge the files of each load of the refined table that has more than it needs at
    ``target_bytes`` a file, and report them: at most ``limit`` loads, those with most files first.

    Also takes away the files that an earlier call has replaced.
    """
    notes = Store(spark, lake.path("merges"))
    replaced_before = [n for n in notes.listed("observation") if n.endswith(".replaced")]
    done = []
    for load, files, size in _crowded(spark, lake, target_bytes, limit):
        rows = read_table(spark, lake, "observation", load).drop("load_type", "load_dt")
        copy = f"{load.folder}/{uuid.uuid4().hex}"
        seen = Observation()
        few = rows.coalesce(math.ceil(size / target_bytes))
        counted = few.observe(seen, F.count(F.lit(1)).alias("n"))
        counted.write.parquet(f"{lake.path('merged')}/{copy}")
        point_to(spark, lake, load, f"{lake.path('merged')}/{copy}")
        names = Store(spark, lake.path("merged")).listed(copy)
        after = sum(name.endswith(".parquet") for name in names)
        done.append((load.load_type, load.load_dt, files, after, seen.get["n"]))
    stamp = utc_stamp().replace(":", ".")
    if done:
        notes.write(f"observation/{stamp}.replaced", json.dumps([list(row[:2]) for row in done]))
    for note in replaced_before:
        for load in json.loads(notes.read(f"observation/{note}") or "[]"):
            if merged_copy(spark, lake, Load(*load)):
                remove_files(spark, lake, "observation", Load(*load))
        notes.remove(f"observation/{note}")
    return spark.createDataFrame(done, _REPORT)


def _crowded(
    spark: SparkSession, lake: Lake, target_bytes: int, limit: int | None
) -> list[tuple[Load, int, int]]:
    """Loads with more files than they need, how many, and their bytes; none twice."""
    folder = F.regexp_extract("path", "/(load_type=[^/]+/load_dt=[^/]+)/[^/]+$", 1).alias("folder")
    files = list_files(spark, lake.path("observation"), "*.parquet")
    sizes = files.groupBy(folder).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    crowded = sizes.where(F.col("files") > F.ceil(F.col("bytes") / target_bytes))
    found = crowded.orderBy(F.desc("files"), "folder").collect()
    held = set(ClaimLog(spark, lake).read()[1])
    left = ingest_ledger(spark, lake).where(is_open()).select("batch_id").distinct()
    held |= {row.batch_id for row in left.collect()}
    merged = set(loads_of(spark, lake, "merged"))
    loads = [(Load.of_folder(*row.folder.split("/")), row.files, row.bytes) for row in found]
    free = [x for x in loads if x[0].batch_id not in held]
    # A copy that was cut short does not count.
    free = [x for x in free if x[0] not in merged or not merged_copy(spark, lake, x[0])]
    return free[:limit]
