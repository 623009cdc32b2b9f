"""Streams: the same outcome as batch runs, once per file, whatever the order."""

from __future__ import annotations

import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import row, write_csv
from pyspark.errors import StreamingQueryException

from obslake import (
    Lake,
    batch_ingest,
    current_answers,
    ensure_database,
    ingest_ledger,
    return_to_incoming,
    running_answer_log,
    stream_hottest,
    stream_improvements,
    stream_ingest,
)
from obslake.plans import ingest as ingest_module
from obslake.schema import HEADER, QUESTION_REGION, QUESTION_TEMPERATURE
from obslake.session import session_with
from obslake.streaming import ROCKSDB


def run(spark, incoming, lake, tmp_path, **options):
    query = stream_ingest(spark, str(incoming), lake, checkpoint=str(tmp_path / "cp"), **options)
    query.awaitTermination()


def outcome(frame):
    return {r.filename: (r.status, r.error) for r in frame.collect()}


def answers(spark, lake):
    log = spark.table(lake.table("answer_log"))
    return {r.question: r.answer for r in current_answers(log).collect()}


def test_stream_screens_loads_and_goes_on(spark, lake, incoming, tmp_path):
    write_csv(incoming, "a.csv", [row(3.5), row(9.25, region="Yorkshire")])
    big = write_csv(incoming, "big.csv", [row(50)] * 30)
    write_csv(incoming, "bad.csv", [row(60)], list(reversed(HEADER)))
    write_csv(incoming, "upper.CSV", [row(70)])
    (incoming / "notes.txt").write_text("notes\n")
    (incoming / "empty.csv").touch()
    size = os.path.getsize(big)
    extension = ("error", "Invalid file extension. Expected a CSV file.")
    expected = {
        "a.csv": ("processed", None),
        "big.csv": (
            "error",
            f"File size {size} must be less than {size} bytes. Use Batch Process for this file.",
        ),
        "bad.csv": ("error", "Invalid columns."),
        "upper.CSV": extension,
        "notes.txt": extension,
    }
    run(spark, incoming, lake, tmp_path, max_bytes=size)
    assert outcome(ingest_ledger(spark, lake)) == expected
    assert answers(spark, lake)[QUESTION_REGION] == "Yorkshire"
    # A second run has nothing to do; a late file with an old time stamp still counts.
    run(spark, incoming, lake, tmp_path, max_bytes=size)
    late = write_csv(incoming, "late.csv", [row(11, "2015-01-01T00:00:00", region="Late")])
    os.utime(late, (1_500_000_000, 1_500_000_000))
    run(spark, incoming, lake, tmp_path, max_bytes=size)
    assert outcome(ingest_ledger(spark, lake)) == {**expected, "late.csv": ("processed", None)}
    assert answers(spark, lake)[QUESTION_REGION] == "Late"
    table = spark.table(lake.table("observation"))
    assert {(r.load_type, r["count"]) for r in table.groupBy("load_type").count().collect()} == {
        ("EVENT-DRIVEN", 3)
    }


def until(condition, seconds=60):
    end = time.time() + seconds
    while not condition() and time.time() < end:
        time.sleep(0.2)
    assert condition()


def test_replaced_and_returned_files_are_loaded_while_the_stream_runs(
    spark, lake, incoming, tmp_path
):
    write_csv(incoming, "a.csv", [row(3.5)])
    write_csv(incoming, "bad.csv", [row(60)], list(reversed(HEADER)))
    query = stream_ingest(
        spark, str(incoming), lake, checkpoint=str(tmp_path / "cp"), look_again=0.5,
        trigger={"processingTime": "500 milliseconds"},
    )
    try:
        query.processAllAvailable()
        states = lambda: sorted(
            (r.filename, r.status) for r in ingest_ledger(spark, lake).collect()
        )
        assert states() == [("a.csv", "processed"), ("bad.csv", "error")]
        write_csv(incoming, "a.csv", [row(9.5)] * 4)
        until(lambda: states().count(("a.csv", "processed")) == 2)
        [refused] = ingest_ledger(spark, lake).where("status = 'error'").collect()
        return_to_incoming(spark, lake, refused.batch_id)
        batches = lambda: {r.batch_id for r in ingest_ledger(spark, lake).collect()}
        known = batches()
        until(lambda: batches() - known)
        until(lambda: ("bad.csv", "error") in states())
        write_csv(incoming, "bad.csv", [row(12)])
        os.utime(incoming / "bad.csv", (86_400, 86_400))
        until(lambda: ("bad.csv", "processed") in states())
    finally:
        query.stop()
    assert answers(spark, lake)[QUESTION_TEMPERATURE] == "12.00"
    assert spark.table(lake.table("observation")).count() == 1 + 4 + 1
    run(spark, incoming, lake, tmp_path)
    assert spark.table(lake.table("observation")).count() == 6


def test_a_batch_run_takes_what_was_too_large_for_the_stream(spark, lake, incoming, tmp_path):
    write_csv(incoming, "big.csv", [row(5)] * 20)
    write_csv(incoming, "bad.csv", [row(60)], list(reversed(HEADER)))
    run(spark, incoming, lake, tmp_path, max_bytes=1000)
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    done = batch_ingest(spark, str(incoming), lake, oversized=True)
    assert outcome(done) == {"big.csv": ("processed", None)}
    assert batch_ingest(spark, str(incoming), lake, oversized=True).isEmpty()
    assert spark.table(lake.table("observation")).count() == 20


def test_stream_equals_batch_file_by_file(spark, lake, incoming, tmp_path):
    for i, temperature in enumerate([5, 11, 3, 11]):
        write_csv(incoming, f"f{i}.csv", [row(temperature, f"2016-02-0{i + 1}T00:00:00", f"R{i}")])
    run(spark, incoming, lake, tmp_path, max_files_per_trigger=1)
    other = Lake(str(tmp_path / "other"), f"{lake.database}_other")
    batch_ingest(spark, str(incoming), other)
    columns = ["screen_temperature", "observation_date", "region", "filename"]
    streamed = spark.table(lake.table("observation")).select(columns).collect()
    batched = spark.table(other.table("observation")).select(columns).collect()
    assert sorted(streamed) == sorted(batched)
    assert answers(spark, lake)[QUESTION_TEMPERATURE] == "11.00"
    assert answers(spark, other)[QUESTION_TEMPERATURE] == "11.00"
    assert spark.table(lake.table("answer_log")).count() == 4
    assert spark.table(other.table("answer_log")).count() == 1
    spark.sql(f"DROP DATABASE {other.database} CASCADE")


def test_a_file_is_loaded_by_one_path_only(spark, lake, incoming, tmp_path):
    write_csv(incoming, "a.csv", [row(5)])
    batch_ingest(spark, str(incoming), lake)
    write_csv(incoming, "b.csv", [row(6)])
    run(spark, incoming, lake, tmp_path)
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    loaded = spark.table(lake.table("observation")).select("filename", "load_type").collect()
    assert sorted(loaded) == [("a.csv", "BATCH"), ("b.csv", "EVENT-DRIVEN")]


def test_replaced_and_old_files_are_taken_by_default(spark, lake, incoming, tmp_path):
    write_csv(incoming, "a.csv", [row(9)])
    run(spark, incoming, lake, tmp_path)
    old = write_csv(incoming, "old.csv", [row(12)])
    os.utime(old, (86_400, 86_400))
    write_csv(incoming, "a.csv", [row(30)] * 3)
    run(spark, incoming, lake, tmp_path)
    run(spark, incoming, lake, tmp_path)
    assert answers(spark, lake)[QUESTION_TEMPERATURE] == "30.00"
    assert spark.table(lake.table("observation")).count() == 1 + 1 + 3
    states = ingest_ledger(spark, lake).select("filename", "status").collect()
    assert sorted(states) == [("a.csv", "processed")] * 2 + [("old.csv", "processed")]


def test_returned_files_come_back_on_the_stream(spark, lake, incoming, tmp_path):
    write_csv(incoming, "good.csv", [row(7)])
    bad = write_csv(incoming, "bad.csv", [row(8)], list(reversed(HEADER)))
    run(spark, incoming, lake, tmp_path, on_error="fail_batch")
    batches = {r.batch_id for r in ingest_ledger(spark, lake).collect()}
    os.remove(bad)
    for batch in batches:
        return_to_incoming(spark, lake, batch)
    run(spark, incoming, lake, tmp_path, on_error="fail_batch")
    assert answers(spark, lake)[QUESTION_TEMPERATURE] == "7.00"


def test_a_file_too_large_for_the_stream_goes_to_a_batch_run(spark, lake, incoming, tmp_path):
    write_csv(incoming, "a.csv", [row(5)] * 20)
    run(spark, incoming, lake, tmp_path, max_bytes=100)
    [refused] = ingest_ledger(spark, lake).collect()
    assert refused.status == "error" and refused.error.endswith("Use Batch Process for this file.")
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    return_to_incoming(spark, lake, refused.batch_id)
    assert outcome(batch_ingest(spark, str(incoming), lake)) == {"a.csv": ("processed", None)}
    assert spark.table(lake.table("observation")).count() == 20


def test_stream_and_batch_at_the_same_time(spark, lake, tmp_path):
    folders = {}
    for name in ("batch", "stream"):
        folders[name] = tmp_path / name
        folders[name].mkdir()
        for i in range(6):
            write_csv(folders[name], f"{name}{i}.csv", [row(i + 1, region=name)] * 50)
    ensure_database(spark, lake)
    with ThreadPoolExecutor(2) as pool:
        streamed = pool.submit(
            run, spark, folders["stream"], lake, tmp_path, max_files_per_trigger=2
        )
        batched = [
            pool.submit(batch_ingest, spark, str(folders["batch"]), lake, limit=2).result()
            for _ in range(3)
        ]
        streamed.result()
    assert all(run.count() == 2 for run in batched)
    done = ingest_ledger(spark, lake)
    assert done.count() == 12 and done.where("status <> 'processed'").isEmpty()
    table = spark.table(lake.table("observation"))
    assert {(r.region, r["count"]) for r in table.groupBy("region").count().collect()} == {
        ("batch", 300),
        ("stream", 300),
    }
    assert spark.table(lake.table("answer_log")).count() == 6


def test_a_stream_on_a_schedule(spark, lake, incoming, tmp_path):
    write_csv(incoming, "a.csv", [row(5)])
    checkpoint, trigger = str(tmp_path / "cp"), {"processingTime": "1 second"}
    query = stream_ingest(spark, str(incoming), lake, checkpoint=checkpoint, trigger=trigger)
    try:
        query.processAllAvailable()
        write_csv(incoming, "b.csv", [row(6)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.table(lake.table("observation")).count() == 2


@pytest.mark.parametrize("step", ["check_headers", "append_refined", "record_answers"])
def test_a_repeated_micro_batch_does_not_double(
    spark, lake, incoming, tmp_path, monkeypatch, step
):
    write_csv(incoming, "a.csv", [row(5)])

    def broken(*_args, **_kwargs):
        raise OSError("store is away")

    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, step, broken)
        patch.setattr(ingest_module, "_reads_once", lambda *_: step != "check_headers")
        with pytest.raises(StreamingQueryException):
            run(spark, incoming, lake, tmp_path)
    write_csv(incoming, "b.csv", [row(6)])
    run(spark, incoming, lake, tmp_path)
    assert outcome(ingest_ledger(spark, lake)) == {
        "a.csv": ("processed", None),
        "b.csv": ("processed", None),
    }
    assert spark.table(lake.table("observation")).count() == 2
    assert answers(spark, lake)[QUESTION_TEMPERATURE] == "6.00"


def test_refused_files_stay_and_come_back(spark, lake, incoming, tmp_path):
    write_csv(incoming, "a.csv", [row(5)])
    write_csv(incoming, "big.csv", [row(30)] * 20)
    run(spark, incoming, lake, tmp_path, max_bytes=500)
    write_csv(incoming, "b.csv", [row(6)])
    run(spark, incoming, lake, tmp_path, max_bytes=500)
    [refused] = ingest_ledger(spark, lake).where("status = 'error'").collect()
    return_to_incoming(spark, lake, refused.batch_id)
    assert outcome(batch_ingest(spark, str(incoming), lake)) == {"big.csv": ("processed", None)}
    assert answers(spark, lake)[QUESTION_TEMPERATURE] == "30.00"


def test_hottest_of_a_stream(spark, tmp_path):
    schema = (
        "screen_temperature double, observation_date timestamp_ntz, observation_time int, "
        "region string, forecast_site_code int, country string"
    )
    source = str(tmp_path / "rows")

    def arrive(*rows):
        frame = spark.createDataFrame(rows, "t double, d string, h int, r string, s int, c string")
        frame.selectExpr(
            "t AS screen_temperature", "CAST(d AS timestamp_ntz) AS observation_date",
            "h AS observation_time", "r AS region", "s AS forecast_site_code", "c AS country",
        ).coalesce(1).write.mode("append").parquet(source)

    def now(name):
        query = (
            stream_hottest(spark.readStream.schema(schema).parquet(source))
            .writeStream.outputMode("complete")
            .format("memory")
            .queryName(name)
            .option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return [tuple(r) for r in spark.table(name).collect()]

    arrive((7.0, "2016-02-03", 1, "B", 1, "X"), (7.0, "2016-02-02", 1, "A", 1, "X"))
    assert now("hot1") == [("2016-02-02", 7.0, "A", "X")]
    arrive((float("nan"), "2016-02-01", 1, "N", 1, "X"), (None, "2016-02-01", 1, "M", 1, "X"))
    arrive((7.0, "2016-02-01", 1, None, 1, None), (6.0, "2016-01-01", 1, "C", 1, "X"))
    assert now("hot2") == [("2016-02-01", 7.0, None, None)]


ROWS = (
    "batch int, screen_temperature double, observation_date timestamp_ntz, observation_time int, "
    "region string, forecast_site_code int, country string"
)


@pytest.mark.parametrize("initial", [0.0, None])
def test_stream_of_improvements_equals_the_log_across_restarts(spark, tmp_path, initial):
    """Ties, missing readings, batches that raise nothing, and a stop after every batch."""
    batches = [
        [(-4.0, "2016-02-01", 1, "Below", 1), (-9.0, "2016-02-01", 2, "B", 1)],
        [(float("nan"), "2016-02-01", 1, "N", 1), (None, None, None, None, None)],
        [(7.0, "2016-02-03", 1, "B", 1), (7.0, "2016-02-02", 5, "A", 1), (7.0, None, 1, "C", 1)],
        [(7.0, "2015-01-01", 1, "Tie", 1), (6.5, "2016-02-01", 1, "Low", 1)],
        [(9.0, "2016-02-09", None, None, 3), (9.0, "2016-02-09", 4, "Z", None)],
        [(9.5, "1066-10-14", 1, "Old", 2)] * 40 + [(9.25, "2016-02-01", 1, "X", 1)] * 40,
    ]
    source, checkpoint = str(tmp_path / "rows"), str(tmp_path / "cp")
    provider = "spark.sql.streaming.stateStore.providerClass"
    with pytest.raises(ValueError, match="RocksDB"):
        stream_improvements(spark.readStream.schema(ROWS).parquet(str(tmp_path)))
    session = session_with(spark, {provider: ROCKSDB, "spark.sql.shuffle.partitions": "2"})
    kinds = "t double, d string, h int, r string, s int"
    for number, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, kinds).selectExpr(
            f"{number} AS batch", "t AS screen_temperature",
            "CAST(d AS timestamp_ntz) AS observation_date", "h AS observation_time",
            "r AS region", "s AS forecast_site_code", "concat(r, '!') AS country",
        )
        frame.coalesce(2).write.mode("append").parquet(source)
        arriving = session.readStream.schema(ROWS).parquet(source)
        query = (
            stream_improvements(arriving, initial=initial)
            .writeStream.outputMode("append")
            .format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(str(tmp_path / "risen"))
        )
        query.awaitTermination()
    columns = ["max_value", "hottest_date", "region", "country"]
    risen = spark.read.parquet(str(tmp_path / "risen")).sort("place_in_log").collect()
    log = running_answer_log(spark.read.parquet(source), "batch", initial=initial)
    expected = log.sort("batch").select(*columns).collect()
    assert [tuple(r[c] for c in columns) for r in risen] == [tuple(r) for r in expected]
    assert [r.place_in_log for r in risen] == list(range(1, len(risen) + 1))
    assert len(risen) == (3 if initial == 0.0 else 4)
