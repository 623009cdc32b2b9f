"""Loading observation files: listed, claimed, screened, checked, appended, answered."""

from __future__ import annotations

import functools
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from obslake.operators.lineage import utc_stamp, with_lineage
from obslake.operators.quality import (
    INVALID_COLUMNS,
    assess,
    check_headers,
    further_columns,
    mark_first_lines,
    quarantined,
    read_headers,
    screen_files,
)
from obslake.plans import folders, ledger
from obslake.plans.answers import record_answers
from obslake.plans.claims import LEASE, Alive, Claim, ClaimLog, Lost
from obslake.plans.lake import (
    Lake,
    Load,
    add_columns,
    append_refined,
    ensure_database,
    read_table,
    register_load,
    remove_load,
    write_load,
)
from obslake.schema import BATCH
from obslake.session import session_with
from obslake.sources.files import list_incoming, reader_paths
from obslake.sources.observations import read_rows

ON_ERROR = ("fail_batch", "quarantine_file")
NEW_COLUMNS = ("refuse", "add")

APPENDED = "appended"

#: Partitions of the ledger that no merge has copied, before it is merged again.
COMPACT_AFTER = 64


def batch_ingest(
    spark: SparkSession,
    incoming: str,
    lake: Lake,
    *,
    limit: int | None = None,
    max_bytes: int | None = None,
    on_error: str = "fail_batch",
    load_dt: str | None = None,
    multi_line: bool = False,
    lease: float = LEASE,
    oversized: bool = False,
    new_columns: str = "refuse",
) -> DataFrame:
    """Load the next files of a folder and bring the answers up to date.

    Returns the run's files with their outcome; no rows, and nothing written,
    if there is no file to process. A run takes all files that are new;
    ``limit`` makes it take that many, in path order, and leave the others.

    ``on_error`` says what a refused file does: ``fail_batch`` refuses all
    files of the run with it, ``quarantine_file`` only that one.

    With ``oversized`` a run also takes the folder's files that a stream, or another run, has
    refused for their size.

    A header that goes on after the expected columns is refused like any other. With
    ``new_columns="add"`` its further columns are added to the table, as text; they are null in
    all rows of files that do not have them.

    Runs may overlap, on one folder too: each file goes to one of them. A run first
    finishes what a run has left behind that was not heard of for ``lease`` seconds.
    """
    ensure_database(spark, lake)
    finish_abandoned(
        spark, lake, on_error=on_error, multi_line=multi_line, new_columns=new_columns
    )
    listed = list_incoming(spark, incoming, None)
    seen: dict[str, int] = {}
    changed = None

    def find(held: list[DataFrame]) -> DataFrame:
        nonlocal changed
        seen["us"] = time.time_ns() // 1000
        files = listed
        if folders.any_settled(spark, lake):
            changed = folders.changed_folders(spark, lake, listed)
            files = folders.in_folders(listed, changed)
        else:
            changed = folders.fingerprints(listed)
        files = ledger.unseen(spark, lake, files, held)
        if oversized:
            files = files.unionAll(ledger.refused_for_size(spark, lake, listed, held))
        return files if limit is None else files.orderBy("path").limit(limit)

    def settle(load: Load, files: DataFrame) -> None:
        if limit is None or files.count() < limit:
            folders.settle(spark, lake, changed, load, seen["us"])

    return ingest_files(
        spark,
        find,
        lake,
        load_type=BATCH,
        load_dt=load_dt,
        max_bytes=max_bytes,
        on_error=on_error,
        multi_line=multi_line,
        new_columns=new_columns,
        lease=lease,
        on_claimed=settle,
    )


def ingest_files(
    spark: SparkSession,
    find: Callable[[list[DataFrame]], DataFrame],
    lake: Lake,
    *,
    load_type: str,
    load_dt: str | None = None,
    max_bytes: int | None = None,
    on_error: str = "quarantine_file",
    multi_line: bool = False,
    new_columns: str = "refuse",
    lease: float = LEASE,
    owner: str = "run",
    on_claimed: Callable[[Load, DataFrame], None] | None = None,
) -> DataFrame:
    """Claim the files that ``find`` names as one batch and load them.

    ``find`` gets the lists of files that other runs hold. It may be called again.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    if new_columns not in NEW_COLUMNS:
        raise ValueError(f"new_columns must be one of {NEW_COLUMNS}")
    log = ClaimLog(spark, lake)
    if load_dt is not None:
        named = Load(load_type, load_dt)
        # A load is replaced by a load of the same name, so a name given by
        # the caller must not be in use.
        if named.batch_id in log.read()[1] or ledger.has_batch(spark, lake, named):
            raise ValueError(f"{named.batch_id} has been used for another load")
    stamp = (lambda: load_dt) if load_dt else utc_stamp
    made = log.claim(load_type, f"{owner}#{uuid.uuid4().hex}", find, load_dt=stamp, lease=lease)
    if made is None:
        return ledger.batch_files(spark, lake, Load(load_type, load_dt or utc_stamp()))
    claim, files = made

    def load_them() -> None:
        claimed = _take(spark, lake, claim.load, files, max_bytes)
        check = lambda: log.check(claim)
        with ThreadPoolExecutor(1) as beside:
            noted = beside.submit(on_claimed or (lambda *_: None), claim.load, files)
            _run(
                spark,
                lake,
                claim.load,
                claimed,
                on_error=on_error,
                multi_line=multi_line,
                new_columns=new_columns,
                check=check,
            )
            noted.result()

    _under(spark, lake, log, claim, load_them)
    _compact(spark, lake, log)
    return ledger.batch_files(spark, lake, claim.load)


def _under(
    spark: SparkSession, lake: Lake, log: ClaimLog, claim: Claim, work: Callable[[], None]
) -> None:
    """Work on a claim's files, with its lease renewed, and close it.

    After an error, too, once the ledger has the files: resume_batches goes on from there. Before
    that, and if the run is broken off, the claim is left to the next run.
    """
    with Alive(log, claim):
        try:
            work()
        except Exception:
            if ledger.batch_files(spark, lake, claim.load).isEmpty():
                log.release(claim)
            else:
                log.close(claim)
            raise
        log.close(claim)


def _take(
    spark: SparkSession, lake: Lake, load: Load, files: DataFrame, max_bytes: int | None
) -> DataFrame:
    """Put the files of a claim on record."""
    return ledger.record(
        spark,
        lake,
        load,
        screen_files(files, max_bytes),
        status=F.when(F.col("status") == "error", "error").otherwise("in_progress"),
        step="screen",
    )


def _compact(spark: SparkSession, lake: Lake, log: ClaimLog) -> None:
    """Keep what a run reads of earlier ones from growing with their number."""
    if ledger.n_not_copied(spark, lake, "ingest_ledger") > COMPACT_AFTER:
        ledger.compact_ledger(spark, lake, set(log.read()[1]))
    if ledger.n_not_copied(spark, lake, "incoming_folders") > COMPACT_AFTER:
        folders.compact_folders(spark, lake)


def finish_abandoned(
    spark: SparkSession,
    lake: Lake,
    *,
    on_error: str,
    multi_line: bool = False,
    new_columns: str = "refuse",
    owner: str | None = None,
    max_bytes: int | None = None,
) -> list[str]:
    """Finish the loads of runs that are gone, and name them: those whose lease has run out, and
    with ``owner`` also those that this owner had begun."""
    log = ClaimLog(spark, lake)
    done = []
    for claim in log.read()[1].values():
        if not (log.expired(claim) or claim.owner.rpartition("#")[0] == owner):
            continue
        mine = log.take_over(claim, owner or "run")
        if mine is None:
            continue
        again = {
            "on_error": on_error,
            "multi_line": multi_line,
            "new_columns": new_columns,
            "max_bytes": max_bytes,
        }
        _under(spark, lake, log, mine, lambda mine=mine: _finish(spark, lake, log, mine, **again))
        done.append(mine.load.batch_id)
    return done


def _finish(
    spark: SparkSession, lake: Lake, log: ClaimLog, claim: Claim, max_bytes: int | None, **options
) -> None:
    register_load(spark, lake, "ingest_ledger", claim.load)  # where it may have stopped
    if ledger.batch_files(spark, lake, claim.load).isEmpty():
        _take(spark, lake, claim.load, log.files(claim), max_bytes)
    resume_batch(spark, lake, claim.load, check=lambda: log.check(claim), **options)


def resume_batch(
    spark: SparkSession,
    lake: Lake,
    load: Load,
    *,
    on_error: str,
    multi_line: bool = False,
    new_columns: str = "refuse",
    check: Callable[[], None] = lambda: None,
) -> None:
    """Take a batch that stopped half way through the steps it has left."""
    register_load(spark, lake, "ingest_ledger", load)  # where it may have stopped
    state = ledger.batch_files(spark, lake, load)
    appended = not state.where(ledger.is_open() & (F.col("step") == APPENDED)).isEmpty()
    _run(
        spark,
        lake,
        load,
        state,
        on_error=on_error,
        multi_line=multi_line,
        new_columns=new_columns,
        appended=appended,
        check=check,
    )


def _run(
    spark: SparkSession,
    lake: Lake,
    load: Load,
    files: DataFrame,
    *,
    on_error: str,
    multi_line: bool,
    new_columns: str,
    appended: bool = False,
    check: Callable[[], None] = lambda: None,
) -> None:
    """Take the claimed files of a batch through header check, append and answers.

    Each step may be repeated without harm: what it writes for the batch
    replaces what an earlier attempt has written. ``check`` raises if the batch
    is no longer this run's.
    """
    step = "header"
    fail_batch = on_error == "fail_batch"
    try:
        good = files.where(ledger.is_open())
        if not appended:
            if fail_batch and _refuse_with_the_first(spark, lake, load, files):
                return
            left = _listed(good)
            if not left:
                return
            if new_columns == "add":
                refused = _append_with_new_columns(
                    spark, lake, left, load, multi_line, fail_batch, check
                )
            elif multi_line or not _reads_once(spark, left):
                good = _record_headers(spark, lake, load, good)
                if fail_batch and _refuse_with_the_first(spark, lake, load, good):
                    return
                left = _listed(good.where(ledger.is_open()))
                if not left:
                    return
                step = "append"
                check()
                rows = with_lineage(read_rows(spark, _paths(left), multi_line), *load)
                _append(spark, lake, rows, load)
                refused: list[str] = []
            else:
                step = "append"
                check()
                refused = _append_and_check(spark, lake, left, load, fail_batch)
            good = _record_appended(spark, lake, load, good, refused, fail_batch)
            if fail_batch and refused or len(refused) == len(left):
                return
        step = "answers"
        check()
        record_answers(spark, lake, read_table(spark, lake, "observation", load), load)
        ledger.record(spark, lake, load, good, status="processed", step=step, error=None)
    except Lost:
        raise
    except Exception as error:
        # What was appended stays marked as such, for the batch to be resumed from there.
        at = F.when(F.col("step") == APPENDED, F.col("step")).otherwise(F.lit(f"{step} failed"))
        left = ledger.batch_files(spark, lake, load).where(ledger.is_open())
        ledger.record(spark, lake, load, left, status="error", step=at, error=f"{step}: {error}")
        raise


def _refuse_with_the_first(
    spark: SparkSession, lake: Lake, load: Load, files: DataFrame
) -> bool:
    """If one of the files was refused, refuse the others with its message."""
    refused = files.where(ledger.is_refused()).orderBy("path").select("error").first()
    if refused is None:
        return False
    others = files.where(ledger.is_open())
    ledger.record(spark, lake, load, others, status="error", step="batch", error=refused.error)
    return True


def _listed(files: DataFrame) -> list[Row]:
    """The files of one run. A file scan keeps the list of its files on the
    driver anyway; the run's file limit bounds it."""
    return files.select("path", "file_uri", "length").collect()


def _paths(files: list[Row]) -> list[str]:
    return reader_paths(row.path for row in files)


def _split_bytes(spark: SparkSession, files: list[Row]) -> int:
    """How Spark would cut the files if opening one cost nothing."""
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    most = as_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    least = as_bytes(spark.conf.get("spark.sql.files.openCostInBytes"))
    total = sum(row.length for row in files)
    return min(most, max(least, total // spark.sparkContext.defaultParallelism))


def _reads_once(spark: SparkSession, files: list[Row]) -> bool:
    """Whether each split can be a task of its own, which lets the load's scan see where files
    begin. With a great many small files that would be as many small tasks and output files;
    their headers are read beforehand."""
    total = sum(row.length for row in files)
    few = len(files) <= 4 * spark.sparkContext.defaultParallelism
    return few or total >= len(files) * _split_bytes(spark, files) / 4


def _record_headers(
    spark: SparkSession, lake: Lake, load: Load, files: DataFrame
) -> DataFrame:
    """Check the headers in one scan and put the outcome on record."""
    header_ok = F.coalesce(F.col("header_ok"), F.lit(False))  # no lines, no header
    return ledger.record(
        spark,
        lake,
        load,
        files.join(check_headers(spark, _paths(_listed(files))), "file_uri", "left"),
        status=F.when(header_ok, "in_progress").otherwise("error"),
        step="header",
        error=F.when(~header_ok, INVALID_COLUMNS),
    )


def _append_and_check(
    spark: SparkSession, lake: Lake, files: list[Row], load: Load, fail_batch: bool
) -> list[str]:
    """Append the rows of the files, their headers checked by the same scan. Returns the files
    that are refused; nothing is appended if ``fail_batch`` and there are any.

    The scan takes headers as lines like others. With a task for each split, the first row
    of a task that reads the beginning of a file is the file's first line; the scan drops it if
    it is the header, and notes the file. Files that are not noted are looked at by themselves,
    and then the others are loaded without them, in a second scan. That is what bad files cost,
    and nothing is lost should Spark put splits together after all.
    """
    split = str(_split_bytes(spark, files))
    each_alone = {
        "spark.sql.files.maxPartitionBytes": split,
        "spark.sql.files.openCostInBytes": split,
    }
    scan = read_rows(session_with(spark, each_alone), _paths(files), header=False)
    lines = with_lineage(mark_first_lines(scan), *load)
    seen = Observation()
    judged = assess(lines).observe(
        seen,
        F.count_if(F.col("is_flawed") & F.col("header_of").isNull()).alias("n_flawed"),
        # At most one name for each file.
        F.collect_set("header_of").alias("good"),
    )
    kept = judged.where(~F.col("is_rejected") & F.col("header_of").isNull())
    append_refined(spark, lake, kept, *load, register=False)
    noted = set(seen.get["good"])
    suspects = [row for row in files if row.file_uri not in noted]
    if not suspects:
        register_load(spark, lake, "observation", load)
        if seen.get["n_flawed"]:
            rows = with_lineage(read_rows(spark, _paths(files)), *load)
            write_load(spark, lake, "quarantine", quarantined(rows), load)
        return []
    verdicts = check_headers(spark, _paths(suspects)).where("header_ok").select("file_uri").collect()
    noted |= {row.file_uri for row in verdicts}
    refused = [row.file_uri for row in files if row.file_uri not in noted]
    left = [row for row in files if row.file_uri in noted]
    if left and not (fail_batch and refused):
        _append(spark, lake, with_lineage(read_rows(spark, _paths(left)), *load), load)
    else:
        remove_load(spark, lake, "observation", load)
    return refused


def _record_appended(
    spark: SparkSession,
    lake: Lake,
    load: Load,
    files: DataFrame,
    refused: list[str],
    fail_batch: bool,
) -> DataFrame:
    """Put on record which files were appended, and which were refused for their header."""
    good = files.where(ledger.is_open())
    if not refused:
        return ledger.record(
            spark, lake, load, good, status="in_progress", step=APPENDED, error=None
        )
    bad = spark.createDataFrame([(uri, True) for uri in refused], "file_uri string, bad boolean")
    marked = good.join(bad, "file_uri", "left").withColumn("bad", F.col("bad").isNotNull())
    step = F.when(F.col("bad"), "header").otherwise("batch" if fail_batch else APPENDED)
    is_error = F.lit(True) if fail_batch else F.col("bad")
    recorded = ledger.record(
        spark,
        lake,
        load,
        marked,
        status=F.when(is_error, "error").otherwise("in_progress"),
        step=step,
        error=F.when(is_error, INVALID_COLUMNS),
    )
    return recorded.where(ledger.is_open())


def _append_with_new_columns(
    spark: SparkSession,
    lake: Lake,
    files: list[Row],
    load: Load,
    multi_line: bool,
    fail_batch: bool,
    check: Callable[[], None],
) -> list[str]:
    """Append files whose headers may go on after the expected columns; returns those refused.

    Files are read by their headers, one scan for each that there is. Their further columns are
    added to the table as text, and are null in all other rows.
    """
    lines = read_headers(spark, _paths(files)).collect()  # a line for each file of the run
    more = {row.file_uri: further_columns(row.header) for row in lines}
    refused = [row.file_uri for row in files if more.get(row.file_uri) is None]
    left = [row for row in files if row.file_uri not in set(refused)]
    check()
    if not left or (fail_batch and refused):
        return refused
    kinds = sorted({tuple(more[row.file_uri]) for row in left})
    add_columns(spark, lake, [name for kind in kinds for name in kind])
    scans = []
    for kind in kinds:
        paths = _paths([row for row in left if tuple(more[row.file_uri]) == kind])
        scan = read_rows(spark, paths, multi_line, further=kind)
        scans.append(with_lineage(scan, *load))
    rows = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    _append(spark, lake, rows, load)
    return refused


def _append(spark: SparkSession, lake: Lake, rows: DataFrame, load: Load) -> None:
    """Append text rows with their lineage, and set aside what cannot be read.

    Rows are parsed once and written as they are parsed; nothing is shuffled
    or cached. The same pass counts rows with a flaw. Only if there are any
    does a second pass collect them.
    """
    seen = Observation()
    judged = assess(rows).observe(seen, F.count_if("is_flawed").alias("n_flawed"))
    append_refined(spark, lake, judged.where(~F.col("is_rejected")), *load)
    # Repeated tasks may count a row twice; it only matters whether there are any.
    if seen.get["n_flawed"]:
        write_load(spark, lake, "quarantine", quarantined(rows), load)


def resume_batches(
    spark: SparkSession,
    lake: Lake,
    *,
    on_error: str = "fail_batch",
    multi_line: bool = False,
    new_columns: str = "refuse",
) -> list[str]:
    """Finish batches that stopped half way, and name them.

    Both those whose run is gone and those that an error has stopped. What other runs are at
    work on is left to them.
    """
    rules = {"on_error": on_error, "multi_line": multi_line, "new_columns": new_columns}
    done = finish_abandoned(spark, lake, **rules)
    left = ledger.ingest_ledger(spark, lake).where(ledger.is_open())
    loads = left.select("load_type", "load_dt").distinct().sort("load_dt", "load_type").collect()
    for row in loads:
        if resume_stopped(spark, lake, Load(*row), **rules):
            done.append(Load(*row).batch_id)
    return done


def resume_stopped(
    spark: SparkSession,
    lake: Lake,
    load: Load,
    *,
    on_error: str,
    multi_line: bool = False,
    new_columns: str = "refuse",
    owner: str = "run",
) -> bool:
    """Claim what an error has left of a batch, and finish it; False if another run has."""
    log = ClaimLog(spark, lake)

    def stopped(_held: list[DataFrame]) -> DataFrame:
        return ledger.batch_files(spark, lake, load).where(ledger.is_open())

    made = log.claim(
        load.load_type,
        f"{owner}#{uuid.uuid4().hex}",
        stopped,
        load_dt=lambda: load.load_dt,
        again=True,
    )
    if made is None:
        return False
    again = {
        "on_error": on_error,
        "multi_line": multi_line,
        "new_columns": new_columns,
        "max_bytes": None,
    }
    _under(spark, lake, log, made[0], lambda: _finish(spark, lake, log, made[0], **again))
    return True


def return_to_incoming(spark: SparkSession, lake: Lake, batch_id: str) -> None:
    """Hand the refused files of a batch back, to be picked up by the next run.

    For files refused along with another one, once that one is out of the
    way, or too large for the stream, to be taken by a batch run.
    """
    returned = ledger.hand_back(spark, lake, batch_id)
    # From now on, so that no run that has not seen them handed back can settle their folders.
    folders.unsettle(spark, lake, returned, time.time_ns() // 1000)
