"""Runs at the same time, runs that die, and what a run costs after many others."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from conftest import row, write_csv
from pyspark.sql import functions as F

from obslake import (
    Lake,
    batch_ingest,
    ensure_database,
    hottest_records,
    ingest_ledger,
    lake_hottest_records,
    lake_maximum,
    list_incoming,
    resume_batches,
    return_to_incoming,
    stream_ingest,
)
from obslake.plans import claims as claims_module
from obslake.plans import folders, ledger
from obslake.plans import ingest as ingest_module
from obslake.plans.claims import Claim, ClaimLog, Lost
from obslake.plans.lake import Load, loads_of, write_load
from obslake.plans.store import Store
from obslake.schema import HEADER

ROOT = Path(__file__).resolve().parents[1]


def outcome(frame):
    return {r.filename: (r.status, r.error) for r in frame.collect()}


def observation(spark, lake):
    return spark.table(lake.table("observation"))


class Killed(BaseException):
    pass


def killed(*_args, **_kwargs):
    raise Killed


def test_only_one_of_many_writes_a_new_file(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: store.write_new("log/1", str(i)), range(24)))
    assert won.count(True) == 1 and store.read("log/1") == str(won.index(True))
    # As on file systems where a rename does not go over what is there.
    store.write("draft", "x")
    store._rename_new("draft", "log/2")
    assert store.read("log/2") == "x"
    store.write("draft", "y")
    with pytest.raises(Exception, match="exists"):
        store._rename_new("draft", "log/2")
    assert store.read("nothing") is None and store.listed("nowhere") == {}


def test_claims_are_in_one_order_and_exclude_each_other(spark, lake, monkeypatch):
    """Many threads claim numbers until none is left; no number is claimed twice."""
    monkeypatch.setattr(claims_module, "SNAPSHOT_EVERY", 3)
    schema = "path string, length bigint, modified_ms bigint"
    everything = spark.createDataFrame([(str(i), i, 0) for i in range(24)], schema)
    log = ClaimLog(spark, lake)
    taken: list[list[str]] = []

    def work(worker):
        while True:

            def find(held):
                left = everything
                for other in [*held, *(spark.createDataFrame([(p,) for p in t], "path string") for t in taken)]:
                    left = left.join(other.select("path"), "path", "left_anti")
                return left.orderBy(F.xxhash64("path", F.lit(worker))).limit(4)

            stamp = lambda: f"2020-01-01T00:00:{time.time_ns() % 10**9}"
            made = log.claim("BATCH", f"w{worker}", find, load_dt=stamp)
            if made is None:
                return
            taken.append([r.path for r in made[1].collect()])
            log.close(made[0])

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(work, range(3)))
    assert sorted(p for t in taken for p in t) == sorted(str(i) for i in range(24))
    assert log.read()[1] == {}
    assert len(log.store.listed("log")) < 12  # entries go when a snapshot stands for them
    # An entry number that a snapshot has freed cannot be used again.
    assert not log.commit(1, "open", Claim("BATCH", "x", "late", 1, "files/none"))


RUN = """
import sys, time
sys.path[:0] = [{root!r}, {root!r} + "/tests"]
from obslake import Lake, batch_ingest, build_session
spark = build_session("2", "run{i}", spark__sql__warehouse__dir={scratch!r} + "/wh{i}",
                      spark__checkpoint__dir={scratch!r} + "/shared{i}")
spark.sparkContext.setLogLevel("ERROR")
lake = Lake({lake!r}, "two_runs")
open({scratch!r} + "/ready{i}", "w").close()
import os
while not os.path.exists({scratch!r} + "/go"):
    time.sleep(0.01)
done = [batch_ingest(spark, {incoming!r}, lake, limit=4).count() for _ in range(4)]
print(done)
"""


def test_two_processes_load_each_file_once(spark, tmp_path, incoming):
    for i in range(10):
        write_csv(incoming, f"f{i}.csv", [row(i + 1, region=f"R{i}")] * (i + 1))
    names = {"root": str(ROOT), "scratch": str(tmp_path), "incoming": str(incoming)}
    root = str(tmp_path / "two")
    runs = [
        subprocess.Popen(
            [sys.executable, "-c", RUN.format(i=i, lake=root, **names)],
            stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True,
        )
        for i in range(2)
    ]
    until = time.time() + 120
    while not all((tmp_path / f"ready{i}").exists() for i in range(2)) and time.time() < until:
        time.sleep(0.1)
    (tmp_path / "go").touch()
    said = [run.communicate(timeout=240) for run in runs]
    assert [run.returncode for run in runs] == [0, 0], said
    done = [json.loads(out) for out, _ in said]
    assert sum(map(sum, done)) == 10, done
    lake = Lake(root, "two_runs")
    ensure_database(spark, lake)
    files = observation(spark, lake).groupBy("filename").count().collect()
    assert {r.filename: r["count"] for r in files} == {f"f{i}.csv": i + 1 for i in range(10)}
    states = ingest_ledger(spark, lake)
    assert states.count() == 10 and states.where("status <> 'processed'").isEmpty()
    spark.sql("DROP DATABASE two_runs CASCADE")


@pytest.mark.parametrize("step", ["screen_files", "append_refined", "record_answers"])
def test_a_dead_run_is_finished_by_the_next_one_after_its_lease(
    spark, lake, incoming, monkeypatch, step
):
    write_csv(incoming, "a.csv", [row(8), row("warm")])
    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, step, killed)
        patch.setattr(ClaimLog, "release", lambda *_: None)  # it gives up nothing
        with pytest.raises(Killed):
            batch_ingest(spark, str(incoming), lake, lease=600)
    write_csv(incoming, "b.csv", [row(9)])
    # The lease is running: the file is the dead run's, and only the other one is taken.
    assert set(outcome(batch_ingest(spark, str(incoming), lake))) == {"b.csv"}
    assert resume_batches(spark, lake) == []
    log = ClaimLog(spark, lake)
    [claim] = log.read()[1].values()
    past = time.time() - 601
    os.utime(f"{lake.path('claims')}/{claims_module._lease(claim)}", (past, past))
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    assert log.read()[1] == {}
    states = outcome(ingest_ledger(spark, lake))
    assert states == {"a.csv": ("processed", None), "b.csv": ("processed", None)}
    assert observation(spark, lake).count() == 2
    assert spark.table(lake.table("quarantine")).count() == 1


def test_a_run_stops_when_its_claim_is_taken_over(spark, lake, incoming, monkeypatch):
    write_csv(incoming, "a.csv", [row(8)])
    first = ingest_module.append_refined

    def overtaken(*args, **kwargs):
        first(*args, **kwargs)
        log = ClaimLog(spark, lake)
        for claim in log.read()[1].values():
            log.take_over(claim, "other")

    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "append_refined", overtaken)
        with pytest.raises(Lost):
            batch_ingest(spark, str(incoming), lake)
    # The other run's claim stands, and so do the files.
    [claim] = ClaimLog(spark, lake).read()[1].values()
    assert claim.owner.startswith("other#")
    assert not ClaimLog(spark, lake).expired(claim)
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    assert outcome(ingest_ledger(spark, lake)) == {"a.csv": ("in_progress", None)}
    ClaimLog(spark, lake).release(claim)
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    assert outcome(ingest_ledger(spark, lake)) == {"a.csv": ("processed", None)}
    assert observation(spark, lake).count() == 1


def test_a_claim_without_ledger_rows_is_kept_after_an_error(spark, lake, incoming, monkeypatch):
    write_csv(incoming, "a.csv", [row(8)])

    def broken(*_args, **_kwargs):
        raise OSError("store is away")

    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "screen_files", broken)
        with pytest.raises(OSError):
            batch_ingest(spark, str(incoming), lake)
    assert batch_ingest(spark, str(incoming), lake).isEmpty()  # it finishes the other run
    assert outcome(ingest_ledger(spark, lake)) == {"a.csv": ("processed", None)}


def test_batch_and_stream_on_one_folder(spark, lake, incoming, tmp_path):
    for i in range(8):
        write_csv(incoming, f"f{i}.csv", [row(i + 1)] * (i + 1))
    ensure_database(spark, lake)

    def stream():
        stream_ingest(
            spark, str(incoming), lake, checkpoint=str(tmp_path / "cp"), max_files_per_trigger=2
        ).awaitTermination()

    with ThreadPoolExecutor(2) as pool:
        streamed = pool.submit(stream)
        for _ in range(3):
            batch_ingest(spark, str(incoming), lake, limit=2)
        streamed.result()
    counts = observation(spark, lake).groupBy("filename").count().collect()
    assert {r.filename: r["count"] for r in counts} == {f"f{i}.csv": i + 1 for i in range(8)}


def bytes_read(spark):
    """Bytes that have been read from local files, by Hadoop's own count."""
    counts = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(count.getBytesRead() for count in counts if count.getScheme() == "file")


def test_headers_are_checked_by_the_scan_that_loads(spark, lake, incoming, monkeypatch):
    for i in range(3):
        write_csv(incoming, f"f{i}.csv", [row(j % 30, region=f"R{j}") for j in range(20_000)])
    size = sum(os.path.getsize(incoming / f"f{i}.csv") for i in range(3))
    calls = []
    whole = ingest_module.check_headers
    monkeypatch.setattr(
        ingest_module, "check_headers", lambda s, paths: calls.append(paths) or whole(s, paths)
    )
    ensure_database(spark, lake)
    before = bytes_read(spark)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 6))
    try:
        batch_ingest(spark, str(incoming), lake)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
    # Reading on to the end of a line costs a buffer for each split; the lake's own files are small.
    assert calls == [] and size <= bytes_read(spark) - before < 1.7 * size
    assert observation(spark, lake).count() == 3 * 20_000
    assert spark.table(lake.table("quarantine")).isEmpty()
    # With a bad file among them, only that one is looked at again.
    write_csv(incoming, "good.csv", [row(50)])
    write_csv(incoming, "late.csv", ["", row(60), ",".join(HEADER)], ["x"])
    write_csv(incoming, "bad.csv", [row(70)] * 3000, list(reversed(HEADER)))
    done = outcome(batch_ingest(spark, str(incoming), lake, on_error="quarantine_file"))
    bad = ("error", "Invalid columns.")
    assert done == {"good.csv": ("processed", None), "bad.csv": bad, "late.csv": bad}
    assert sorted(Path(p).name for paths in calls for p in paths) == ["bad.csv", "late.csv"]
    assert observation(spark, lake).count() == 3 * 20_000 + 1


def test_the_hottest_rows_are_read_from_the_loads_that_hold_them(spark, lake, incoming, monkeypatch):
    for i in range(6):
        rows = [row((j * 7 + i) % 30, region=f"R{j}", site=j) for j in range(20_000)]
        write_csv(incoming, f"f{i}.csv", rows + [row(40 if i in (2, 4) else 35, region=f"Top{i}")])
        batch_ingest(spark, str(incoming), lake)
    write_csv(incoming, "none.csv", [row("")])
    batch_ingest(spark, str(incoming), lake)
    table = spark.table(lake.table("observation"))
    parts = Path(lake.path("observation")).rglob("*.parquet")
    size = sum(part.stat().st_size for part in parts)
    before = bytes_read(spark)
    assert lake_maximum(spark, lake).first().max_value == 40
    assert bytes_read(spark) - before < 0.3 * size / 6
    before = bytes_read(spark)
    found = lake_hottest_records(spark, lake).collect()
    assert bytes_read(spark) - before < 3 * size / 6
    assert sorted(found) == sorted(hottest_records(table).collect())
    assert sorted(r.region for r in found) == ["Top2", "Top4"]
    # A load without an entry in the log counts, too.
    write_csv(incoming, "open.csv", [row(50, region="Open")])
    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "record_answers", killed)
        with pytest.raises(Killed):
            batch_ingest(spark, str(incoming), lake)
    assert lake_maximum(spark, lake).first().max_value == 50
    assert [r.region for r in lake_hottest_records(spark, lake).collect()] == ["Open"]


def test_no_rows_have_no_hottest(spark, lake, incoming):
    ensure_database(spark, lake)
    assert lake_maximum(spark, lake).collect() == [(None,)]
    assert lake_hottest_records(spark, lake).isEmpty()


def test_splits_put_together_are_loaded_right(spark, lake, incoming, monkeypatch):
    """If a task reads several files after all, they are looked at one by one."""
    for i in range(6):
        write_csv(incoming, f"f{i}.csv", [row(i + 1)] * 3)
    write_csv(incoming, "bad.csv", [row(70)], list(reversed(HEADER)))
    monkeypatch.setattr(ingest_module, "session_with", lambda s, _conf: s)
    done = outcome(batch_ingest(spark, str(incoming), lake, on_error="quarantine_file"))
    assert done.pop("bad.csv") == ("error", "Invalid columns.")
    assert set(done.values()) == {("processed", None)}
    assert observation(spark, lake).count() == 18
    assert spark.table(lake.table("quarantine")).isEmpty()


def test_many_small_files_have_their_headers_checked_beforehand(spark, lake, incoming):
    for i in range(20):
        write_csv(incoming, f"f{i}.csv", [row(i)])
    write_csv(incoming, "bad.csv", [row(70)], list(reversed(HEADER)))
    done = outcome(batch_ingest(spark, str(incoming), lake, on_error="quarantine_file"))
    assert done.pop("bad.csv") == ("error", "Invalid columns.")
    assert len(done) == 20 and set(done.values()) == {("processed", None)}
    assert observation(spark, lake).count() == 20


def simulated_loads(spark, lake, n):
    """The ledger of ``n`` runs of two files each."""
    ensure_database(spark, lake)
    batch = F.concat(F.lit("BATCH-"), "load_dt")
    files = spark.range(2 * n).select(
        F.concat(F.lit("file:/in/"), F.col("id") % 7, F.lit("/f"), "id", F.lit(".csv")).alias("path"),
        F.lit(10).cast("bigint").alias("length"),
        F.col("id").alias("modified_ms"),
        F.format_string("2020-01-01T00:00:00.%06d", F.floor(F.col("id") / 2)).alias("load_dt"),
    )
    rows = files.select(
        "path", F.col("path").alias("file_uri"), F.lit("f").alias("filename"), "length",
        "modified_ms", batch.alias("batch_id"), F.lit("processed").alias("status"),
        F.lit("answers").alias("step"), F.lit(None).cast("string").alias("error"),
        F.col("modified_ms").alias("recorded_us"), F.lit("BATCH").alias("load_type"), "load_dt",
    )
    path = lake.path("ingest_ledger")
    rows.repartition(4, "load_dt").write.partitionBy("load_type", "load_dt").mode("append").parquet(path)
    spark.catalog.recoverPartitions(lake.table("ingest_ledger"))


def test_the_ledger_stays_small_whatever_came_before(spark, lake, incoming, monkeypatch):
    monkeypatch.setattr(ingest_module, "COMPACT_AFTER", 3)
    simulated_loads(spark, lake, 120)
    before = {(r.path, r.status) for r in ingest_ledger(spark, lake).collect()}
    for i in range(8):
        write_csv(incoming, f"f{i}.csv", [row(i + 1)])
        batch_ingest(spark, str(incoming), lake)
        # Two merged partitions at most, and the runs since the merge before the last one.
        if i > 4:
            assert len(loads_of(spark, lake, "ingest_ledger")) <= 2 * 3 + 6
            assert len(loads_of(spark, lake, "incoming_folders")) <= 2 * 3 + 6
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    states = ingest_ledger(spark, lake)
    assert states.count() == 240 + 8
    assert before <= {(r.path, r.status) for r in states.collect()}
    assert {r.load_type for r in states.select("load_type").distinct().collect()} == {"BATCH"}
    # The catalog shows the same.
    shown = spark.table(lake.table("ingest_ledger")).select("path").distinct()
    assert shown.count() == 248


def test_a_merge_cut_short_does_no_harm(spark, lake, incoming, monkeypatch):
    for i in range(4):
        write_csv(incoming, f"f{i}.csv", [row(i + 1)])
        batch_ingest(spark, str(incoming), lake)
    before = sorted(ingest_ledger(spark, lake).collect())
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "write_load", killed)
        with pytest.raises(Killed):
            ledger.compact_ledger(spark, lake)
    half = ingest_ledger(spark, lake).limit(2)
    write_load(spark, lake, "ingest_ledger", half, Load("SNAPSHOT", "2020-01-01T00:00:00.000000"))
    for _ in range(3):
        assert sorted(ingest_ledger(spark, lake).collect()) == before
        ledger.compact_ledger(spark, lake)
    assert sorted(ingest_ledger(spark, lake).collect()) == before
    assert {load.load_type for load in loads_of(spark, lake, "ingest_ledger")} == {"SNAPSHOT"}
    with pytest.raises(ValueError, match="another load"):
        batch_ingest(spark, str(incoming), lake, load_dt=before[0].load_dt)


def test_open_batches_and_returned_files_outlive_merges(spark, lake, incoming, monkeypatch):
    write_csv(incoming, "bad.csv", [row(1)], list(reversed(HEADER)))
    write_csv(incoming, "good.csv", [row(2)])
    [refused, _] = batch_ingest(spark, str(incoming), lake).collect()
    os.remove(incoming / "bad.csv")

    def broken(*_args, **_kwargs):
        raise OSError("store is away")

    write_csv(incoming, "stopped.csv", [row(3)])
    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "record_answers", broken)
        with pytest.raises(OSError):
            batch_ingest(spark, str(incoming), lake)
    for _ in range(3):
        ledger.compact_ledger(spark, lake)
    return_to_incoming(spark, lake, refused.batch_id)
    for _ in range(3):
        ledger.compact_ledger(spark, lake)
    assert outcome(batch_ingest(spark, str(incoming), lake)) == {"good.csv": ("processed", None)}
    assert return_to_incoming(spark, lake, refused.batch_id) is None
    assert set(outcome(batch_ingest(spark, str(incoming), lake))) <= {"bad.csv"}
    assert len(resume_batches(spark, lake)) == 1
    assert observation(spark, lake).count() == 2


def test_only_changed_folders_are_compared(spark, lake, incoming):
    for name in ("a", "b", "c"):
        (incoming / name).mkdir()
        for i in range(3):
            write_csv(incoming / name, f"{name}{i}.csv", [row(i + 1)])
    changed = lambda: sorted(
        r.folder[-1] for r in folders.changed_folders(spark, lake, list_incoming(spark, str(incoming))).collect()
    )
    ensure_database(spark, lake)
    assert changed() == ["a", "b", "c"]
    batch_ingest(spark, str(incoming), lake, limit=4)
    assert changed() == ["a", "b", "c"]  # some files were left
    batch_ingest(spark, str(incoming), lake)
    assert changed() == []
    old = write_csv(incoming / "a", "old.csv", [row(9)])
    os.utime(old, (86_400, 86_400))
    replaced = write_csv(incoming / "b", "b0.csv", [row(7)])
    os.utime(replaced, (2_000_000_000, 2_000_000_000))
    assert changed() == ["a", "b"]
    assert set(outcome(batch_ingest(spark, str(incoming), lake))) == {"old.csv", "b0.csv"}
    assert changed() == []
    os.remove(old)
    assert changed() == ["a"]
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    assert observation(spark, lake).count() == 11


def test_handing_back_makes_folders_be_looked_at_again(spark, lake, incoming):
    write_csv(incoming, "bad.csv", [row(1)], list(reversed(HEADER)))
    [refused] = batch_ingest(spark, str(incoming), lake).collect()
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    return_to_incoming(spark, lake, refused.batch_id)
    # A run that had read the ledger before that may still record its fingerprint.
    listed = list_incoming(spark, str(incoming))
    prints = folders.fingerprints(listed)
    folders.settle(spark, lake, prints, Load("BATCH", "2020-01-01T00:00:00.000000"), 1)
    assert outcome(batch_ingest(spark, str(incoming), lake)) == {
        "bad.csv": ("error", "Invalid columns.")
    }
