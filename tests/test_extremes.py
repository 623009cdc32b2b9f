"""Extreme values against brute force, and the plans behind them."""

from __future__ import annotations

import math
import random
import re
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from obslake import (
    Measure,
    column_profile,
    hottest_answer,
    hottest_records,
    late_records,
    max_temperature,
    running_answer_log,
    union_by_name,
    union_by_position,
)

MEASURE = Measure(value="v", when="at", place="r", country=None, tiebreak=("r", "id"))
SCHEMA = "b int, v double, at timestamp_ntz, r string, id int"
START = datetime(2016, 2, 1)


def frame(spark, rows):
    """Rows of (batch, value, day offset, region)."""
    data = [
        (b, v, None if day is None else START + timedelta(days=day), r, i)
        for i, (b, v, day, r) in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def rank(line):
    _, v, day, r = line[:4]
    return (-v, day is None, day or 0, r is None, r or "", line[4])


def best(rows):
    """The hottest row by brute force."""
    numbered = [(*line, i) for i, line in enumerate(rows)]
    valid = [line for line in numbered if line[1] is not None and not math.isnan(line[1])]
    return min(valid, key=rank) if valid else None


def day_of(line):
    return None if line[2] is None else (START + timedelta(days=line[2])).strftime("%Y-%m-%d")


def improvements(rows, initial):
    log, top = [], initial
    for b in sorted({line[0] for line in rows}):
        numbered = [(*line, i) for i, line in enumerate(rows) if line[0] == b]
        valid = [line for line in numbered if line[1] is not None and not math.isnan(line[1])]
        if not valid:
            continue
        found = min(valid, key=rank)
        if top is None or found[1] > top:
            top = found[1]
            log.append((b, found[1], day_of(found), found[3]))
    return log


lines = st.lists(
    st.tuples(
        st.integers(0, 6),
        st.sampled_from([None, float("nan"), -2.0, 0.0, 1.5, 1.5, 3.25, 7.0]),
        st.sampled_from([None, 0, 1, 2, 40]),
        st.sampled_from([None, "A", "B", "C"]),
    ),
    min_size=1,
    max_size=25,
)
few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@few
@given(rows=lines)
def test_hottest_answer_is_the_brute_force_row(spark, rows):
    found = [tuple(r) for r in hottest_answer(frame(spark, rows), MEASURE).collect()]
    top = best(rows)
    assert found == ([] if top is None else [(day_of(top), top[1], top[3])])
    records = hottest_records(frame(spark, rows), MEASURE).count()
    assert records == (0 if top is None else sum(line[1] == top[1] for line in rows))
    highest = max_temperature(frame(spark, rows), MEASURE).first().max_value
    assert highest == (None if top is None else top[1])


@few
@given(rows=lines, initial=st.sampled_from([None, 0.0, 2.0]))
def test_running_answer_log_is_the_brute_force_log(spark, rows, initial):
    log = running_answer_log(frame(spark, rows), "b", MEASURE, initial=initial, groups=3)
    assert sorted(tuple(r) for r in log.collect()) == improvements(rows, initial)


def test_running_answer_log_over_many_batches(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(400), round(rng.gauss(10, 5), 1), 1, "A") for _ in range(4000)]
    log = running_answer_log(frame(spark, rows), "b", MEASURE)
    assert sorted(tuple(r) for r in log.collect()) == improvements(rows, 0.0)


def test_ties_and_order_of_batches_with_a_rising_series(spark):
    rows = [(b, float(b), 0, "A") for b in range(1, 60)] * 2
    log = running_answer_log(frame(spark, rows), "b", MEASURE, groups=4)
    assert [r.batch for r in log.sort("batch").collect()] == list(range(1, 60))


def test_column_profile(spark):
    rows = spark.createDataFrame([(1, None), (2, "x"), (None, "y")], "a int, `b.c` string")
    assert [tuple(r) for r in column_profile(rows).collect()] == [
        ("a", "int", 3, 2),
        ("b.c", "string", 3, 2),
    ]
    assert column_profile(rows.limit(0), ["a"]).collect() == [("a", "int", 0, 0)]


def test_unions(spark):
    left = spark.createDataFrame([(1, "a")], "n int, s string")
    right = spark.createDataFrame([("b", 2)], "s string, n int")
    assert sorted(union_by_name(left, right).collect()) == [(1, "a"), (2, "b")]
    named = union_by_name(left, right.drop("s"), left)
    assert named.count() == 3 and named.where("s IS NULL").count() == 1
    swapped = union_by_position(left, right.selectExpr("n AS other", "s AS more"))
    assert swapped.columns == ["n", "s"] and swapped.count() == 2


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "stored")
    spark.range(2000).selectExpr(
        "int(id % 7) AS b", "double(id) AS v", "timestamp_ntz'2016-02-01' AS at", "'R' AS r",
        "int(id) AS id", "repeat('x', 20) AS wide",
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_flagship_plan(stored):
    plan = plan_of(hottest_answer(stored, MEASURE))
    assert "TakeOrderedAndProject" in plan
    assert re.search(r"PushedFilters: \[IsNotNull\(v\), EqualTo\(v,ScalarSubquery", plan)
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert {frozenset(schema.split(",")) for schema in schemas} == {
        frozenset({"v:double"}),
        frozenset({"v:double", "at:timestamp_ntz", "r:string", "id:int"}),
    }
    assert "wide" not in plan
    # The only exchanges are of partial maxima, to one row.
    assert set(re.findall(r"Arguments: (\w+), ENSURE_REQUIREMENTS", plan)) == {"SinglePartition"}


def test_running_log_plan(stored):
    plan = plan_of(running_answer_log(stored, "b", MEASURE))
    assert "wide" not in plan
    assert "GreaterThanOrEqual(v,ScalarSubquery" in plan
    assert "partial_min" in plan
    # The table is read once more after the maxima were written; all else reads those.
    scans = re.findall(r"Location: InMemoryFileIndex \[(.*?)\]", plan)
    assert len([scan for scan in scans if "obslake-maxima" not in scan]) == 1 < len(scans)
    # No cross join is used, and a window over everything has a row per range.
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_load_plan_has_no_shuffle_and_compiles(spark, tmp_path):
    from obslake.operators import assess, quarantined, to_canonical, with_lineage
    from obslake.operators.quality import mark_first_lines
    from obslake.sources import read_rows
    from conftest import row, write_csv

    write_csv(tmp_path, "a.csv", [row(1)])
    rows = with_lineage(read_rows(spark, str(tmp_path)), "BATCH", "2016-02-01")
    loaded = assess(rows).where(~F.col("is_rejected")).drop("is_rejected", "is_flawed")
    plan = plan_of(loaded)
    assert "Exchange" not in plan and "Sort" not in plan
    lines = mark_first_lines(read_rows(spark, str(tmp_path), header=False))
    checked = assess(with_lineage(lines, "BATCH", "2016-02-01"))
    # The rows pass by the observation as the load's do, which ends a compiled stage.
    checked = checked.observe(Observation(), F.collect_set("header_of").alias("good"))
    checked = checked.where(~F.col("is_rejected") & F.col("header_of").isNull())
    assert "Exchange" not in plan_of(checked) and "Sort" not in plan_of(checked)
    for frame in (loaded, assess(rows), quarantined(rows), to_canonical(rows), checked):
        assert largest_method(frame) < 8000


def largest_method(df):
    """Bytes of generated code; beyond 8000 the JVM runs a method uncompiled."""
    debug = df.sparkSession._jvm.org.apache.spark.sql.execution.debug
    package = getattr(getattr(debug, "package$"), "MODULE$")
    code = package.codegenString(df._jdf.queryExecution().executedPlan())
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code))


def test_listing_does_not_read_contents(spark, tmp_path):
    from obslake import list_incoming

    (tmp_path / "a.csv").write_text("x")
    assert "content" not in plan_of(list_incoming(spark, str(tmp_path)))


def late_by_brute_force(rows, delay):
    """(batch, time) of rows behind the latest time of all earlier batches, less the delay."""
    order = sorted({r[0] for r in rows}, key=lambda b: (b is not None, b or 0))
    late, latest = [], None
    for batch in order:
        times = [r[1] for r in rows if r[0] == batch and r[1] is not None]
        if latest is not None:
            late += [(batch, t, latest - delay - t) for t in times if t < latest - delay]
        latest = max([*times, latest] if latest is not None else times, default=None)
    return sorted(late, key=repr)


@pytest.mark.parametrize("groups", [None, 4])
@pytest.mark.parametrize("hours", [0, 5])
def test_late_rows_are_those_behind_the_batches_before(spark, monkeypatch, groups, hours):
    monkeypatch.setattr("obslake.operators.improvements.PER_RANGE", 10)
    draw = random.Random(hours)
    start = datetime(2016, 3, 27)  # clocks change in many zones
    rows = [
        (draw.choice([None, *range(60)]), draw.choice([None, *[start + timedelta(hours=h / 4) for h in range(300)]]))
        for _ in range(500)
    ]
    rows += [(1000, start), (1001, None)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        df = spark.createDataFrame(rows, "b int, at timestamp_ntz")
        found = late_records(df, "b", "at", f"{hours} hours", groups=groups).collect()
        assert late_records(df.where("false"), "b", "at").isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    expected = late_by_brute_force(rows, timedelta(hours=hours))
    assert sorted(((r.b, r["at"], r.late_by) for r in found), key=repr) == expected
