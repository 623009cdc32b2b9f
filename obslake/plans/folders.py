"""Which folders have not changed since all their files were claimed.

A folder is known by a fingerprint of its listing: how many files it has, and two hashes over
the path, length and modification time of each of them. The fingerprint is recorded when a run
has claimed whatever was new in the folder. As long as a listing gives the same one, no file of
the folder needs to be looked up in the ledger; once a file comes, goes or is replaced, however
old its time stamp, all of them are. Handing files back drops their folders' fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.operators.lineage import utc_stamp
from obslake.plans.lake import Lake, Load, loads_of, read_table, write_load
from obslake.plans.ledger import merge
from obslake.schema import RETURNED

_TABLE = "incoming_folders"
_PRINT = ["folder", "n_files", "digest_a", "digest_b"]


def _folder() -> Column:
    return F.expr("left(path, length(path) - length(substring_index(path, '/', -1)) - 1)")


def fingerprints(files: DataFrame) -> DataFrame:
    """folder, n_files, digest_a, digest_b of each folder in a listing."""
    version = ["path", "length", "modified_ms"]
    return files.groupBy(_folder().alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.bit_xor(F.xxhash64(*version)).alias("digest_a"),
        F.bit_xor(F.xxhash64(F.lit(1), *version)).alias("digest_b"),
    )


def any_settled(spark: SparkSession, lake: Lake) -> bool:
    return bool(loads_of(spark, lake, _TABLE))


def changed_folders(spark: SparkSession, lake: Lake, files: DataFrame) -> DataFrame:
    """Fingerprints of the folders of a listing that differ from what is recorded."""
    last = F.max_by(F.struct(*_PRINT[1:]), "recorded_us").alias("last")
    known = read_table(spark, lake, _TABLE).groupBy("folder").agg(last)
    known = known.select("folder", "last.*")
    return fingerprints(files).join(known, _PRINT, "left_anti")


def in_folders(files: DataFrame, folders: DataFrame) -> DataFrame:
    """Files of a listing that lie in one of these folders."""
    chosen = folders.select("folder")
    return files.withColumn("folder", _folder()).join(chosen, "folder", "left_semi").drop("folder")


def settle(spark: SparkSession, lake: Lake, folders: DataFrame, load: Load, seen_us: int) -> None:
    """Record the fingerprints of folders of which every file is claimed.

    ``seen_us`` is when the ledger was read for that: files handed back since then count.
    """
    write_load(spark, lake, _TABLE, folders.withColumn("recorded_us", F.lit(seen_us)), load)


def unsettle(spark: SparkSession, lake: Lake, files: DataFrame, at_us: int) -> None:
    """Drop the fingerprints of the folders of these files."""
    none = [F.lit(-1).cast("bigint").alias(name) for name in _PRINT[1:]]
    folders = files.select(_folder().alias("folder")).distinct().select("folder", *none)
    dropped = folders.withColumn("recorded_us", F.lit(at_us))
    write_load(spark, lake, _TABLE, dropped, Load(RETURNED, utc_stamp()))


def compact_folders(spark: SparkSession, lake: Lake) -> None:
    merge(spark, lake, _TABLE, ["folder"], set())
