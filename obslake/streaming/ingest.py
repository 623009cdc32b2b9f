"""Loading files as they arrive."""

from __future__ import annotations

import hashlib
import threading
import warnings
from collections.abc import Callable
from typing import Any

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obslake.plans import ledger
from obslake.plans.claims import LEASE, ClaimLog
from obslake.plans.ingest import finish_abandoned, ingest_files, resume_stopped
from obslake.plans.lake import Lake, Load, ensure_database
from obslake.plans.store import Store
from obslake.schema import EVENT_DRIVEN
from obslake.sources.files import LISTING_SCHEMA, list_files, stream_files


def stream_ingest(
    spark: SparkSession,
    incoming: str,
    lake: Lake,
    *,
    checkpoint: str,
    max_files_per_trigger: int = 1000,
    max_bytes: int | None = None,
    on_error: str = "quarantine_file",
    trigger: dict[str, Any] | None = None,
    max_file_age: str = "106751d",
    multi_line: bool = False,
    lease: float = LEASE,
    look_again: float = 60.0,
    new_columns: str = "refuse",
) -> StreamingQuery:
    """Start loading a folder's files as they arrive.

    The stream carries names and sizes; each micro-batch loads its files like
    a batch run. Files are screened by name and, where ``max_bytes`` is given,
    by size (``STREAM_MAX_BYTES`` is the usual ceiling). ``max_files_per_trigger=1``
    handles every file on its own. Files stay where they are, refused ones too; what
    became of them is in the ledger.

    ``trigger`` is passed on: ``{"availableNow": True}`` (default) takes what
    is there and stops, ``{"processingTime": "15 minutes"}`` goes on.

    Files that were replaced under their old name, or handed back by ``return_to_incoming``, are
    files to be loaded again. Spark's file source knows files by their path alone and never
    shows one twice, so they are looked for in the listing, at the start and then every
    ``look_again`` seconds, and put before the stream as a second source.

    ``max_file_age`` is wider than any time stamp reaches back, because the source
    passes over files that lie further than that behind the newest one. The price is driver
    memory for the names of files seen; lower it where files keep pace.

    ``new_columns="add"`` adds columns that a header has after the expected ones to the table.
    Streams and batch runs may work on one folder: each file goes to one of them.
    """
    ensure_database(spark, lake)
    options = {
        "on_error": on_error,
        "multi_line": multi_line,
        "new_columns": new_columns,
        "owner": checkpoint,
    }

    def load(find: Callable[[list[DataFrame]], DataFrame]) -> None:
        # A checkpoint has one query at a time, so what it has begun is there to be finished.
        finish_abandoned(spark, lake, max_bytes=max_bytes, **options)
        more = {"load_type": EVENT_DRIVEN, "max_bytes": max_bytes, "lease": lease}
        ingest_files(spark, find, lake, **more, **options)

    def take(arrived: DataFrame, _epoch: int) -> None:
        # At most max_files_per_trigger names. They move from the stream's
        # session, which has settings of its own, to the caller's.
        # A file that was replaced just now may be in both sources.
        files = spark.createDataFrame(list(set(arrived.collect())), LISTING_SCHEMA).coalesce(1)
        # A repeated micro-batch finds its files claimed by its first attempt.
        left = ledger.states_of(spark, lake, files).where(
            ledger.is_open() & (F.col("load_type") == EVENT_DRIVEN)
        )
        for stopped in left.select("load_type", "load_dt").distinct().collect():
            resume_stopped(spark, lake, Load(*stopped), **options)
        load(lambda held: ledger.unseen(spark, lake, files, held))

    arrivals = f"{lake.path('arrivals')}/{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"
    Store(spark, arrivals).make()

    def look() -> None:
        held = [log.files(claim) for claim in log.read()[1].values()]
        found = ledger.known_again(spark, lake, list_files(spark, incoming), held)
        found = found.select(*spark.createDataFrame([], LISTING_SCHEMA).columns)
        if not found.isEmpty():
            # What is put there twice, or was loaded by then, is found to be known.
            per_file = {"maxRecordsPerFile": max_files_per_trigger}
            found.coalesce(1).write.options(**per_file).mode("append").parquet(arrivals)

    log = ClaimLog(spark, lake)
    look()
    again = spark.readStream.schema(LISTING_SCHEMA).option("maxFilesPerTrigger", 1)
    files = stream_files(spark, incoming, max_files_per_trigger, max_file_age)
    query = (
        files.unionByName(again.parquet(arrivals))
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    if trigger and "processingTime" in trigger:
        threading.Thread(target=_keep_looking, args=(query, look, look_again), daemon=True).start()
    return query


def _keep_looking(query: StreamingQuery, look: Callable[[], None], seconds: float) -> None:
    """Look every so often while the stream runs. What fails now may work the next time."""
    while True:
        try:
            if query.awaitTermination(seconds):
                return
        except StreamingQueryException:
            return  # whoever waits for the query is told
        try:
            look()
        except Exception as error:
            warnings.warn(f"could not look for replaced files: {error}", stacklevel=1)
