"""Which files were seen, and what became of them.

The ledger is append-only: a row per file and step. A file is known by path,
length and modification time, so a replaced file counts as a new one. What a
file store would show by moving files between folders is the ``status`` of a
file's latest row:

``in_progress``  claimed by a run
``processed``    its rows and answers are stored
``error``        refused by a check, or caught in a failed step
``incoming``     handed back, to be picked up again

Each run adds a partition with a few small files. ``compact_ledger`` copies the latest rows
of all files into one partition and takes out those that they were copied from. A row may
be there twice for a while, which changes nothing: only a file's latest row counts. For the
same reason a copy that was cut short does no harm.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.operators.lineage import utc_stamp
from obslake.operators.quality import INVALID_SIZE
from obslake.plans.lake import Lake, Load, loads_of, read_table, remove_load, write_load
from obslake.plans.store import Store
from obslake.schema import BATCH, EVENT_DRIVEN, RETURNED, SNAPSHOT

FILE_KEY = ["path", "length", "modified_ms"]

_TABLE = "ingest_ledger"

# Steps at which a file is refused for what it is. A failure at any other
# step is no fault of the file, and the batch can be resumed.
REFUSING_STEPS = ["screen", "header", "batch"]


def record(
    spark: SparkSession, lake: Lake, load: Load, files: DataFrame, **values: Column | str | None
) -> DataFrame:
    """Append a row per file, with the given columns set, and return these
    rows as they were stored, so that later steps do not depend on how the
    files were found."""
    stamp = time.time_ns() // 1000
    stamped = files.withColumns(
        {
            **{name: v if isinstance(v, Column) else F.lit(v) for name, v in values.items()},
            "batch_id": F.lit(load.batch_id),
            "recorded_us": F.lit(stamp),
        }
    )
    write_load(spark, lake, _TABLE, stamped, load, mode="append")
    return read_table(spark, lake, _TABLE, load).where(F.col("recorded_us") == stamp)


def ingest_ledger(spark: SparkSession, lake: Lake) -> DataFrame:
    """The current state: the latest row of each file."""
    return _latest(_named(read_table(spark, lake, _TABLE)))


def batch_files(spark: SparkSession, lake: Lake, load: Load) -> DataFrame:
    """How the files stand that one batch has claimed."""
    return _latest(read_table(spark, lake, _TABLE, load))


def states_of(spark: SparkSession, lake: Lake, files: DataFrame) -> DataFrame:
    """How the files of a short listing stand, as far as they are known."""
    rows = read_table(spark, lake, _TABLE).join(files, FILE_KEY, "left_semi")
    return _latest(_named(rows))


def unseen(
    spark: SparkSession, lake: Lake, files: DataFrame, held: list[DataFrame] | None = None
) -> DataFrame:
    """Files of a listing that no run has claimed, or that were handed back.

    This looks at the whole ledger, so it keeps to numbers, which a hash
    aggregate can hold: a file is claimed if its last row is not the one
    that handed it back. ``held`` are lists of files that count as claimed, too.
    """
    returned = F.when(F.col("status") == "incoming", F.col("recorded_us"))
    claimed = (
        read_table(spark, lake, _TABLE)
        .groupBy(*FILE_KEY)
        .agg(F.max("recorded_us").alias("last"), F.max(returned).alias("returned"))
        .where(F.col("returned").isNull() | (F.col("last") > F.col("returned")))
    )
    claimed = claimed.select(*FILE_KEY)
    for files_held in held or []:
        claimed = claimed.unionAll(files_held.select(*FILE_KEY))
    return files.join(claimed, FILE_KEY, "left_anti")


def known_again(
    spark: SparkSession, lake: Lake, files: DataFrame, held: list[DataFrame] | None = None
) -> DataFrame:
    """Files of a listing to be loaded although their path was seen before: replaced
    since, or handed back."""
    paths = read_table(spark, lake, _TABLE).select("path").distinct()
    return unseen(spark, lake, files, held).join(paths, "path", "left_semi")


def refused_for_size(
    spark: SparkSession, lake: Lake, files: DataFrame, held: list[DataFrame]
) -> DataFrame:
    """Files of a listing that were refused for nothing but their size."""
    size = INVALID_SIZE.partition("%s")[0]
    states = ingest_ledger(spark, lake)
    refused = states.where(
        (F.col("status") == "error") & (F.col("step") == "screen") & F.col("error").startswith(size)
    )
    found = files.join(refused, FILE_KEY, "left_semi")
    for files_held in held:
        found = found.join(files_held, FILE_KEY, "left_anti")
    return found


def hand_back(spark: SparkSession, lake: Lake, batch_id: str) -> DataFrame:
    """Record the refused files of a batch as handed back, and return them.

    That goes to a partition of its own: nothing is added to a load that is over.
    """
    known = ingest_ledger(spark, lake)
    refused = known.where((F.col("batch_id") == batch_id) & is_refused()).withColumns(
        {
            "status": F.lit("incoming"),
            "step": F.lit("returned"),
            "error": F.lit(None).cast("string"),
            "recorded_us": F.lit(time.time_ns() // 1000),
        }
    )
    returned = Load(RETURNED, utc_stamp())
    write_load(spark, lake, _TABLE, refused, returned)
    return _named(read_table(spark, lake, _TABLE, returned))


def has_batch(spark: SparkSession, lake: Lake, load: Load) -> bool:
    rows = read_table(spark, lake, _TABLE)
    return not rows.where(F.col("batch_id") == load.batch_id).isEmpty()


def compact_ledger(spark: SparkSession, lake: Lake, open_batches: set[str] | None = None) -> None:
    """Merge the ledger: one row for each file, in one partition.

    Loads at work, those of ``open_batches`` and those with files that are not done, keep their
    own partitions. Partitions that a merge has copied are taken out by the next merge, so
    whoever was reading them has that long to finish.
    """
    merge(spark, lake, _TABLE, FILE_KEY, open_batches or set(), is_open())


def n_not_copied(spark: SparkSession, lake: Lake, name: str) -> int:
    """How many partitions of a table no merge has copied yet."""
    notes = Store(spark, lake.path("merges"))
    copied = {
        tuple(load)
        for note in notes.listed(name)
        for load in json.loads(notes.read(f"{name}/{note}") or "[]")
    }
    return sum(tuple(load) not in copied for load in loads_of(spark, lake, name))


def merge(
    spark: SparkSession,
    lake: Lake,
    name: str,
    key: list[str],
    open_batches: set[str],
    at_work: Column | None = None,
) -> None:
    """Copy the latest row of each key into a new partition, and take out the partitions that
    the merge before this one has copied."""
    notes = Store(spark, lake.path("merges"))
    copied_before = [note for note in notes.listed(name) if note.endswith(".copied")]
    loads = loads_of(spark, lake, name)
    rows = read_table(spark, lake, name)
    latest = _latest(rows, key)
    held = set(open_batches)
    if at_work is not None:
        left = latest.where(at_work).select("batch_id").distinct()
        held |= {row.batch_id for row in left.collect()}
    stamp = utc_stamp()
    write_load(spark, lake, name, latest, Load(SNAPSHOT, stamp))
    copied = [list(load) for load in loads if load.batch_id not in held]
    notes.write(f"{name}/{stamp.replace(':', '.')}.copied", json.dumps(copied))
    for note in copied_before:
        for load in json.loads(notes.read(f"{name}/{note}") or "[]"):
            remove_load(spark, lake, name, Load(*load))
        notes.remove(f"{name}/{note}")


def is_open() -> Column:
    """Claimed and not done: at work, or left behind by a step that failed."""
    return (F.col("status") == "in_progress") | ((F.col("status") == "error") & ~_by_check())


def is_refused() -> Column:
    return (F.col("status") == "error") & _by_check()


def _by_check() -> Column:
    return F.col("step").isin(REFUSING_STEPS)


def _latest(rows: DataFrame, key: list[str] = FILE_KEY) -> DataFrame:
    state = [name for name in rows.columns if name not in key]
    latest = F.max_by(F.struct(*state), F.col("recorded_us")).alias("state")
    return rows.groupBy(*key).agg(latest).select(*key, "state.*").select(*rows.columns)


def _named(rows: DataFrame) -> DataFrame:
    """Rows with the load they are about, whichever partition they stand in."""
    of_stream = F.col("batch_id").startswith(f"{EVENT_DRIVEN}-")
    load_type = F.when(of_stream, F.lit(EVENT_DRIVEN)).otherwise(F.lit(BATCH))
    # What a batch is named by is its load type, a dash and its time.
    load_dt = F.substr("batch_id", F.length(load_type) + 2)
    return rows.withColumns({"load_type": load_type, "load_dt": load_dt})
