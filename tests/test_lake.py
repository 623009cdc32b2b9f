"""Tables in the catalog, ad-hoc SQL, and readers."""

from __future__ import annotations

import os

import pytest
from conftest import row, write_csv

from obslake import (
    append_refined,
    batch_ingest,
    drop_refined,
    ensure_database,
    merge_small_files,
    publish_answers,
    query_refined,
    read_observations,
    read_refined,
    read_rows,
    resume_batches,
    to_canonical,
    with_lineage,
    work_dir,
)
from obslake.plans import Load, read_table
from obslake.schema import COLUMNS, QUESTION_REGION


def parquet_files(folder):
    return [f for _, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]


def test_dropped_tables_keep_their_files_and_come_back(spark, lake, incoming):
    write_csv(incoming, "a.csv", [row(3.5), row(4)])
    batch_ingest(spark, str(incoming), lake)
    drop_refined(spark, lake)
    assert not spark.catalog.tableExists(lake.table("observation"))
    assert spark.catalog.databaseExists(lake.database)
    assert read_refined(spark, lake.path("observation")).count() == 2
    ensure_database(spark, lake)
    assert spark.table(lake.table("observation")).count() == 2

    drop_refined(spark, lake, database=True)
    assert not spark.catalog.databaseExists(lake.database)
    assert parquet_files(lake.path("observation"))
    ensure_database(spark, lake)
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    drop_refined(spark, lake, database=True)
    drop_refined(spark, lake, database=True)


def test_a_load_is_added_once_next_to_others(spark, lake, incoming):
    ensure_database(spark, lake)
    ensure_database(spark, lake)
    path = write_csv(incoming, "a.csv", [row(3.5), row(4)])
    loads = [("BATCH", "1"), ("BATCH", "2"), ("EVENT-DRIVEN", "1"), ("BATCH", "2")]
    for load_type, load_dt in loads:
        rows = to_canonical(with_lineage(read_rows(spark, path), load_type, load_dt))
        append_refined(spark, lake, rows, load_type, load_dt)
    found = query_refined(
        spark,
        f"SELECT load_type, load_dt, filename, count(*) AS n FROM {lake.table('observation')} "
        "GROUP BY ALL ORDER BY ALL",
    )
    assert [tuple(r) for r in found.collect()] == [
        ("BATCH", "1", "a.csv", 2),
        ("BATCH", "2", "a.csv", 2),
        ("EVENT-DRIVEN", "1", "a.csv", 2),
    ]


def test_load_names():
    for load in (Load("BATCH", "2016-02-01T00:00:00.5"), Load("EVENT-DRIVEN", "2016-02-01")):
        assert Load.of(load.batch_id) == load
    assert Load("BATCH", "a:b").folder == "load_type=BATCH/load_dt=a%3Ab"
    with pytest.raises(ValueError, match="not usable"):
        _ = Load("BATCH", "../x").folder


def test_answers_are_a_view(spark, lake, incoming):
    ensure_database(spark, lake)
    publish_answers(spark, lake)
    question = f"SELECT answer FROM {lake.table('answers')} WHERE question = '{QUESTION_REGION}'"
    assert query_refined(spark, question).collect() == []
    for i, region in enumerate(["Wales", "Fife"]):
        write_csv(incoming, f"{i}.csv", [row(i + 1, region=region)])
        batch_ingest(spark, str(incoming), lake)
        assert query_refined(spark, question).collect() == [(region,)]


def test_reading_is_typed_and_total(spark, incoming):
    rows = [row("x", date="2016-02-01"), row(" 4.5 "), "1,2", row(1, WindSpeed=1.5)]
    write_csv(incoming, "a.csv", rows)
    found = read_observations(spark, str(incoming))
    assert found.columns == COLUMNS
    assert dict(found.dtypes)["observation_date"] == "timestamp_ntz"
    readings = [r.screen_temperature for r in found.collect()]
    assert sorted(readings, key=str) == [1.0, 4.5, None, None]
    assert found.where("wind_speed IS NULL").count() == 2


def test_work_folder_is_below_the_shared_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark), work_dir(spark)
    assert first.startswith(base) and first != second


def crowded_load(spark, lake, incoming, load_dt="1", files=40):
    path = write_csv(incoming, f"f{load_dt}.csv", [row(i, region=f"R{i}") for i in range(400)])
    rows = to_canonical(with_lineage(read_rows(spark, path), "BATCH", load_dt))
    append_refined(spark, lake, rows.repartition(files), "BATCH", load_dt)


def test_small_files_are_merged_and_nothing_else_changes(spark, lake, incoming, monkeypatch):
    ensure_database(spark, lake)
    for load_dt in ("1", "2"):
        crowded_load(spark, lake, incoming, load_dt)
    table = lambda: spark.table(lake.table("observation"))
    before = sorted(map(repr, table().collect()))
    reading = table()  # planned with the old files
    old = parquet_files(lake.path("observation"))

    # A copy that is cut short: nothing points to it, and it is made anew.
    def killed(*_args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr("obslake.plans.merging.point_to", killed)
        with pytest.raises(KeyboardInterrupt):
            merge_small_files(spark, lake)
    for found in (lake.path("merged") + "/" + Load("BATCH", "1").folder,):
        for copy in os.listdir(found):
            os.remove(f"{found}/{copy}/_SUCCESS")
    assert len(table().inputFiles()) == 80
    report = {tuple(r) for r in merge_small_files(spark, lake).collect()}
    assert report == {("BATCH", "1", 40, 1, 400), ("BATCH", "2", 40, 1, 400)}
    assert len(table().inputFiles()) == 2
    assert sorted(map(repr, table().collect())) == before
    assert parquet_files(lake.path("observation")) == old
    assert sorted(map(repr, reading.collect())) == before
    # The next call takes the old files away, and finds nothing else to do.
    assert merge_small_files(spark, lake).isEmpty()
    assert parquet_files(lake.path("observation")) == []
    spark.catalog.refreshTable(lake.table("observation"))
    assert sorted(map(repr, table().collect())) == before
    # Another catalog finds the merged files; a load that is written again has its own.
    drop_refined(spark, lake)
    ensure_database(spark, lake)
    assert sorted(map(repr, table().collect())) == before
    assert read_table(spark, lake, "observation", Load("BATCH", "1")).count() == 400
    crowded_load(spark, lake, incoming, "1", files=3)
    assert table().where("load_dt = '1'").count() == 400
    assert len(table().inputFiles()) == 4
    assert sorted(map(repr, table().collect())) == before


def test_loads_at_work_are_not_merged(spark, lake, incoming, monkeypatch):
    from obslake.plans import ingest as ingest_module

    for i in range(5):
        write_csv(incoming, f"f{i}.csv", [row(i)])

    def broken(*_args, **_kwargs):
        raise OSError("store is away")

    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "record_answers", broken)
        with pytest.raises(OSError):
            batch_ingest(spark, str(incoming), lake)
    assert merge_small_files(spark, lake).isEmpty()
    resume_batches(spark, lake)
    [merged] = merge_small_files(spark, lake).collect()
    assert merged.files_before == 5 and merged.files_after == 1 and merged.n_rows == 5
    assert batch_ingest(spark, str(incoming), lake).isEmpty()
    assert spark.table(lake.table("observation")).count() == 5
