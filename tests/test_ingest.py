"""Loading runs: outcomes per file, answers, failures and repetition."""

from __future__ import annotations

import os

import pytest
from conftest import row, write_csv
from pyspark.sql import functions as F

from obslake import (
    answer_or_default,
    batch_ingest,
    current_answers,
    drop_refined,
    ensure_database,
    ingest_ledger,
    list_incoming,
    resume_batches,
    return_to_incoming,
)
from obslake.plans import answers as answers_module
from obslake.plans import ingest as ingest_module
from obslake.schema import HEADER, QUESTION_DATE, QUESTION_REGION, QUESTION_TEMPERATURE

INVALID = "Invalid columns."


def outcome(frame):
    return {r.filename: (r.status, r.error) for r in frame.collect()}


def answers(spark, lake, **options):
    log = spark.table(lake.table("answer_log"))
    return {r.question: r.answer for r in current_answers(log, **options).collect()}


def observation(spark, lake):
    return spark.table(lake.table("observation"))


def test_two_files_one_answer(spark, lake, incoming):
    write_csv(incoming, "a.csv", [row(3.5), row(9.25, "2016-02-02T00:00:00", "Yorkshire")])
    write_csv(incoming, "b.csv", [row(15.8, "2016-03-17T00:00:00", "Highland"), row(-2)])
    done = batch_ingest(spark, str(incoming), lake)
    assert outcome(done) == {"a.csv": ("processed", None), "b.csv": ("processed", None)}
    assert answers(spark, lake) == {
        QUESTION_DATE: "2016-03-17",
        QUESTION_TEMPERATURE: "15.80",
        QUESTION_REGION: "Highland",
    }
    table = observation(spark, lake)
    assert len(table.columns) == 18
    counts = table.groupBy("filename", "load_type").count().collect()
    assert {(r.filename, r.load_type, r["count"]) for r in counts} == {
        ("a.csv", "BATCH", 2),
        ("b.csv", "BATCH", 2),
    }


def test_nothing_to_do_writes_nothing(spark, lake, incoming):
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    assert batch_ingest(spark, str(incoming / "missing"), lake).isEmpty()
    assert not any(f.endswith(".parquet") for _, _, names in os.walk(lake.root) for f in names)


def test_same_file_is_loaded_once_and_a_changed_one_again(spark, lake, incoming):
    path = write_csv(incoming, "a.csv", [row(3.5)])
    batch_ingest(spark, str(incoming), lake)
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    assert observation(spark, lake).count() == 1
    write_csv(incoming, "a.csv", [row(3.5), row(4.5)])
    os.utime(path, (2_000_000_000, 2_000_000_000))
    assert outcome(batch_ingest(spark, str(incoming), lake)) == {"a.csv": ("processed", None)}
    assert observation(spark, lake).count() == 3


def test_equal_reading_keeps_the_earlier_answer(spark, lake, incoming):
    write_csv(incoming, "a.csv", [row(15.8, region="First")])
    batch_ingest(spark, str(incoming), lake)
    write_csv(incoming, "b.csv", [row(15.8, "2016-01-01T00:00:00", region="Second")])
    batch_ingest(spark, str(incoming), lake)
    assert answers(spark, lake)[QUESTION_REGION] == "First"
    write_csv(incoming, "c.csv", [row(15.81, region="Third")])
    batch_ingest(spark, str(incoming), lake)
    assert answers(spark, lake)[QUESTION_REGION] == "Third"
    write_csv(incoming, "d.csv", [row(1, region="Fourth")])
    batch_ingest(spark, str(incoming), lake)
    assert answers(spark, lake)[QUESTION_REGION] == "Third"
    assert spark.table(lake.table("answer_log")).count() == 4


def test_ties_in_a_batch_go_to_the_earliest(spark, lake, incoming):
    rows = [
        row(7, "2016-02-03T00:00:00", "A", hour=1),
        row(7, "2016-02-02T00:00:00", "D", hour=5),
        row(7, "2016-02-02T00:00:00", "C", hour=4),
        row(7, "2016-02-02T00:00:00", "B", hour=4, site=9),
    ]
    write_csv(incoming, "a.csv", rows)
    batch_ingest(spark, str(incoming), lake)
    found = answers(spark, lake)
    assert (found[QUESTION_DATE], found[QUESTION_REGION]) == ("2016-02-02", "B")


def test_no_answer_below_the_initial_value(spark, lake, incoming):
    write_csv(incoming, "a.csv", [row(-3), row(-1.5, region="Fife"), row(-0.0, region="Zero")])
    batch_ingest(spark, str(incoming), lake)
    assert answers(spark, lake) == {}
    assert answers(spark, lake, initial=None)[QUESTION_REGION] == "Zero"
    assert answers(spark, lake, initial=None)[QUESTION_TEMPERATURE] == "0.00"


def test_no_temperatures_no_update(spark, lake, incoming):
    write_csv(incoming, "a.csv", [row(""), row("NA"), row("NaN")])
    assert outcome(batch_ingest(spark, str(incoming), lake)) == {"a.csv": ("processed", None)}
    assert answers(spark, lake, initial=None) == {}
    assert observation(spark, lake).count() == 3
    assert spark.table(lake.table("quarantine")).count() == 0


def test_unreadable_values(spark, lake, incoming):
    rows = [
        row("NaN"),
        row("Infinity"),
        row("warm"),
        row("1e999"),
        row(5, date="yesterday"),
        row(6, region="Kept", WindSpeed="calm"),
        row(4, WindGust="17.0"),
        "1,2,3",
        row(3) + ",extra",
    ]
    write_csv(incoming, "a.csv", rows)
    assert outcome(batch_ingest(spark, str(incoming), lake)) == {"a.csv": ("processed", None)}
    kept = {r.screen_temperature: r for r in observation(spark, lake).collect()}
    assert set(kept) == {None, 6.0, 4.0}
    assert kept[6.0].wind_speed is None and kept[4.0].wind_gust == 17
    assert answers(spark, lake)[QUESTION_REGION] == "Kept"
    flaws = spark.table(lake.table("quarantine")).collect()
    assert sorted((r.column_name or "", r.reason, r.row_kept) for r in flaws) == [
        ("", "malformed row", False),
        ("", "malformed row", False),
        ("observation_date", "invalid timestamp", False),
        ("screen_temperature", "invalid number", False),
        ("screen_temperature", "invalid number", False),
        ("screen_temperature", "invalid number", False),
        ("wind_speed", "invalid number", True),
    ]
    raw = {r.raw for r in flaws}
    assert "1,2,3" in raw and rows[1] in raw and rows[5] in raw


def test_session_settings_do_not_matter(spark, lake, incoming):
    settings = {
        "spark.sql.ansi.enabled": "false",
        "spark.sql.session.timeZone": "Asia/Kolkata",
        "spark.sql.caseSensitive": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        write_csv(incoming, "a.csv", [row("warm"), row(7.5, "2016-02-01T23:30:00"), row("")])
        assert outcome(batch_ingest(spark, str(incoming), lake)) == {"a.csv": ("processed", None)}
        assert batch_ingest(spark, str(incoming), lake).isEmpty()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    assert answers(spark, lake)[QUESTION_DATE] == "2016-02-01"
    assert answers(spark, lake)[QUESTION_TEMPERATURE] == "7.50"
    assert spark.table(lake.table("quarantine")).count() == 1


def test_null_region_is_a_null_answer(spark, lake, incoming):
    write_csv(incoming, "a.csv", [row(8, region="")])
    batch_ingest(spark, str(incoming), lake)
    found = answers(spark, lake)
    assert found[QUESTION_REGION] is None and found[QUESTION_TEMPERATURE] == "8.00"


def test_quoted_fields(spark, lake, incoming):
    line = row(8, SiteName='"a ""b"" c, d"', Country='""')
    write_csv(incoming, "a.csv", [line])
    batch_ingest(spark, str(incoming), lake)
    [found] = observation(spark, lake).collect()
    assert found.site_name == 'a "b" c, d' and found.region == "Wales" and found.country is None


BAD_HEADERS = {
    "reordered.csv": [*HEADER[1:], HEADER[0]],
    "case.csv": [name.lower() for name in HEADER],
    "fourteen.csv": HEADER[:-1],
    "sixteen.csv": [*HEADER, "More"],
}


def test_bad_headers_are_refused_one_by_one(spark, lake, incoming):
    write_csv(incoming, "good.csv", [row(8)])
    write_csv(incoming, "quoted.csv", [row(9)], [f'"{name}"' for name in HEADER])
    (incoming / "bom.csv").write_bytes(
        b"\xef\xbb\xbf" + (",".join(HEADER) + "\r\n" + row(7) + "\r\n").encode()
    )
    (incoming / "blank.csv").write_text("\n\n")
    for name, header in BAD_HEADERS.items():
        write_csv(incoming, name, [row(50)], header)
    done = outcome(batch_ingest(spark, str(incoming), lake, on_error="quarantine_file"))
    good = {name: ("processed", None) for name in ("good.csv", "quoted.csv", "bom.csv")}
    assert done == {**good, **{name: ("error", INVALID) for name in [*BAD_HEADERS, "blank.csv"]}}
    assert observation(spark, lake).count() == 3
    assert answers(spark, lake)[QUESTION_TEMPERATURE] == "9.00"
    assert batch_ingest(spark, str(incoming), lake).isEmpty()


def test_a_bad_file_fails_the_batch_and_the_rest_can_be_returned(spark, lake, incoming):
    write_csv(incoming, "a.csv", [row(8)])
    bad = write_csv(incoming, "b.csv", [row(50)], BAD_HEADERS["reordered.csv"])
    done = batch_ingest(spark, str(incoming), lake)
    assert outcome(done) == {"a.csv": ("error", INVALID), "b.csv": ("error", INVALID)}
    assert observation(spark, lake).count() == 0 and answers(spark, lake) == {}
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    os.remove(bad)
    return_to_incoming(spark, lake, done.first().batch_id)
    assert outcome(batch_ingest(spark, str(incoming), lake)) == {"a.csv": ("processed", None)}
    assert observation(spark, lake).count() == 1


def test_a_repeated_header_line_is_data(spark, lake, incoming):
    write_csv(incoming, "a.csv", [row(8), ",".join(HEADER), row(9)])
    batch_ingest(spark, str(incoming), lake)
    assert observation(spark, lake).count() == 2
    assert spark.table(lake.table("quarantine")).where("not row_kept").count() > 0


def test_empty_and_header_only_files(spark, lake, incoming):
    (incoming / "empty.csv").touch()
    write_csv(incoming, "header.csv", [])
    assert outcome(batch_ingest(spark, str(incoming), lake)) == {"header.csv": ("processed", None)}
    assert observation(spark, lake).count() == 0


def test_listing(spark, incoming):
    for name in ("c.csv", "a.csv", "b.CSV", "d.txt"):
        (incoming / name).write_text("x\n")
    (incoming / "nested").mkdir()
    (incoming / "nested" / "e.csv").write_text("x\n")
    names = [r.filename for r in list_incoming(spark, str(incoming)).collect()]
    assert names == ["a.csv", "c.csv", "e.csv"]
    assert [r.filename for r in list_incoming(spark, str(incoming), 2).collect()] == names[:2]


def test_runs_take_the_files_in_turn(spark, lake, incoming):
    for i in range(5):
        write_csv(incoming, f"f{i}.csv", [row(i + 1)])
    runs = [sorted(outcome(batch_ingest(spark, str(incoming), lake, limit=2))) for _ in range(4)]
    assert runs == [["f0.csv", "f1.csv"], ["f2.csv", "f3.csv"], ["f4.csv"], []]
    assert observation(spark, lake).count() == 5


def test_batch_has_no_size_limit_unless_given(spark, lake, incoming):
    path = write_csv(incoming, "a.csv", [row(8)])
    size = os.path.getsize(path)
    done = batch_ingest(spark, str(incoming), lake, max_bytes=size, on_error="quarantine_file")
    message = f"File size {size} must be less than {size} bytes. Use Batch Process for this file."
    assert outcome(done) == {"a.csv": ("error", message)}
    return_to_incoming(spark, lake, done.first().batch_id)
    assert outcome(batch_ingest(spark, str(incoming), lake)) == {"a.csv": ("processed", None)}


def test_odd_file_names(spark, lake, incoming):
    names = ["a b.csv", "c[1].csv", "d{x}.csv", "e%20f.csv", "g*.csv", "ü.csv", "q?.csv"]
    names += ["p+q.csv", "back\\slash.csv", "ha#sh.csv"]
    for i, name in enumerate(names):
        write_csv(incoming, name, [row(i + 1, region=f"R{i}")])
    done = outcome(batch_ingest(spark, str(incoming), lake))
    assert done == {name: ("processed", None) for name in names}
    found = {(r.filename, r.region) for r in observation(spark, lake).collect()}
    assert found == {(name, f"R{i}") for i, name in enumerate(names)}


def test_a_large_file_is_read_in_splits(spark, lake, incoming):
    rows = [row(i % 300 / 10, region=f"R{i}") for i in range(3000)]
    write_csv(incoming, "a.csv", [*rows, row(99.5, region="Last")])
    write_csv(incoming, "b.csv", rows, BAD_HEADERS["reordered.csv"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        done = outcome(batch_ingest(spark, str(incoming), lake, on_error="quarantine_file"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert done == {"a.csv": ("processed", None), "b.csv": ("error", INVALID)}
    assert observation(spark, lake).count() == 3001
    assert answers(spark, lake)[QUESTION_REGION] == "Last"


@pytest.mark.parametrize("step", ["header", "append", "answers"])
def test_a_failed_step_is_recorded_and_resumed_without_doubling(
    spark, lake, incoming, monkeypatch, step
):
    write_csv(incoming, "a.csv", [row(8), row("warm")])
    target = {
        "header": (ingest_module, "check_headers"),
        "append": (ingest_module, "quarantined"),
        "answers": (answers_module, "top_reading"),
    }[step]

    def broken(*_args, **_kwargs):
        raise OSError("store is away")

    with monkeypatch.context() as patch:
        patch.setattr(*target, broken)
        patch.setattr(ingest_module, "_reads_once", lambda *_: step != "header")
        with pytest.raises(OSError, match="store is away"):
            batch_ingest(spark, str(incoming), lake)
    assert outcome(ingest_ledger(spark, lake)) == {"a.csv": ("error", f"{step}: store is away")}
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    assert len(resume_batches(spark, lake)) == 1
    assert outcome(ingest_ledger(spark, lake)) == {"a.csv": ("processed", None)}
    assert observation(spark, lake).count() == 1
    assert spark.table(lake.table("quarantine")).count() == 1
    assert answers(spark, lake)[QUESTION_TEMPERATURE] == "8.00"
    assert resume_batches(spark, lake) == []


def test_a_run_that_stopped_dead_is_resumed(spark, lake, incoming, monkeypatch):
    write_csv(incoming, "a.csv", [row(8)])

    class Killed(BaseException):
        pass

    def killed(*_args, **_kwargs):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "record_answers", killed)
        with pytest.raises(Killed):
            batch_ingest(spark, str(incoming), lake)
    assert outcome(ingest_ledger(spark, lake)) == {"a.csv": ("in_progress", None)}
    resume_batches(spark, lake)
    assert outcome(ingest_ledger(spark, lake)) == {"a.csv": ("processed", None)}
    assert observation(spark, lake).count() == 1


def test_a_load_name_is_not_used_twice(spark, lake, incoming):
    write_csv(incoming, "a.csv", [row(8)])
    batch_ingest(spark, str(incoming), lake, load_dt="2016-02-01T00:00:00.000000")
    write_csv(incoming, "b.csv", [row(9)])
    with pytest.raises(ValueError, match="another load"):
        batch_ingest(spark, str(incoming), lake, load_dt="2016-02-01T00:00:00.000000")
    assert observation(spark, lake).count() == 1


def test_one_batch_equals_many_in_any_order(spark, lake, incoming):
    rows = {f"f{i}.csv": [row(t, region=f"R{i}")] for i, t in enumerate([5, 11, 3, 11, 9])}
    for name in ("f2.csv", "f4.csv", "f1.csv", "f0.csv", "f3.csv"):
        write_csv(incoming, name, rows[name])
        batch_ingest(spark, str(incoming), lake)
    assert answers(spark, lake)[QUESTION_TEMPERATURE] == "11.00"
    assert answers(spark, lake)[QUESTION_REGION] == "R1"


def test_answer_lookup_with_default(spark, lake, incoming):
    ensure_database(spark, lake)
    log = spark.table(lake.table("answer_log"))
    none_yet = answer_or_default(current_answers(log), QUESTION_TEMPERATURE, "0")
    assert none_yet.collect() == [("0",)]
    write_csv(incoming, "a.csv", [row(8)])
    batch_ingest(spark, str(incoming), lake)
    log = spark.table(lake.table("answer_log"))
    found = answer_or_default(current_answers(log), QUESTION_TEMPERATURE, "0")
    assert found.collect() == [("8.00",)]


def test_multi_line_fields(spark, lake, incoming):
    write_csv(incoming, "a.csv", [row(8, SiteName='"two\nlines"')])
    batch_ingest(spark, str(incoming), lake, multi_line=True)
    [found] = observation(spark, lake).select(F.col("site_name")).collect()
    assert found.site_name == "two\nlines"


MORE = [*HEADER, "Cloud Base", "UV"]


def test_new_columns_are_refused_unless_asked_for(spark, lake, incoming):
    write_csv(incoming, "more.csv", [row(8) + ",300,2"], MORE)
    done = batch_ingest(spark, str(incoming), lake)
    assert outcome(done) == {"more.csv": ("error", INVALID)}
    with pytest.raises(ValueError, match="new_columns"):
        batch_ingest(spark, str(incoming), lake, new_columns="yes")


def test_new_columns_are_added_to_the_table(spark, lake, incoming, tmp_path):
    write_csv(incoming, "old.csv", [row(7)])
    batch_ingest(spark, str(incoming), lake)
    write_csv(incoming, "plain.csv", [row(6), row("warm")])
    write_csv(incoming, "more.csv", [row(8) + ",300,2", row(9) + ",,", row(5), row("x") + ",1,1"], MORE)
    write_csv(incoming, "uv.csv", [row(10) + ',"a, b"'], [*HEADER, '"UV"'])
    for name, header in {
        "moved.csv": ["UV", *HEADER], "twice.csv": [*HEADER, "UV", "uv"],
        "clash.csv": [*HEADER, "filename"], "unnamed.csv": [*HEADER, ""],
        "other.csv": HEADER[:-1],
    }.items():
        write_csv(incoming, name, [row(50)], header)
    (incoming / "blank.csv").write_text("\n\n")
    options = {"on_error": "quarantine_file", "new_columns": "add"}
    done = outcome(batch_ingest(spark, str(incoming), lake, **options))
    good = {name: ("processed", None) for name in ("plain.csv", "more.csv", "uv.csv")}
    bad = ("moved.csv", "twice.csv", "clash.csv", "unnamed.csv", "other.csv", "blank.csv")
    assert done == {**good, **{name: ("error", INVALID) for name in bad}}

    def loaded():
        rows = observation(spark, lake).collect()
        return sorted((r.filename, r.screen_temperature, r.cloud_base, r.uv) for r in rows)

    expected = sorted([
        ("old.csv", 7.0, None, None), ("plain.csv", 6.0, None, None),
        ("more.csv", 8.0, "300", "2"), ("more.csv", 9.0, None, None),
        ("uv.csv", 10.0, None, "a, b"),
    ])
    assert loaded() == expected
    flaws = spark.table(lake.table("quarantine")).select("filename", "reason").collect()
    assert sorted(map(tuple, flaws)) == [
        ("more.csv", "invalid number"), ("more.csv", "malformed row"),
        ("plain.csv", "invalid number"),
    ]
    assert answers(spark, lake)[QUESTION_TEMPERATURE] == "10.00"
    # A run without the option goes on as before, and a new catalog knows the columns.
    write_csv(incoming, "later.csv", [row(3)])
    batch_ingest(spark, str(incoming), lake)
    drop_refined(spark, lake)
    ensure_database(spark, lake)
    assert loaded() == sorted([*expected, ("later.csv", 3.0, None, None)])


def test_a_bad_header_refuses_a_batch_with_new_columns(spark, lake, incoming):
    write_csv(incoming, "more.csv", [row(8) + ",300,2"], MORE)
    write_csv(incoming, "bad.csv", [row(50)], HEADER[:-1])
    done = outcome(batch_ingest(spark, str(incoming), lake, new_columns="add"))
    assert done == {"more.csv": ("error", INVALID), "bad.csv": ("error", INVALID)}
    assert observation(spark, lake).count() == 0
