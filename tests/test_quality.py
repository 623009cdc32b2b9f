"""Checks on files and fields, value by value."""

from __future__ import annotations

import random

from conftest import row, write_csv
from pyspark.sql import functions as F

from obslake import infer_types, read_inferred, read_rows, screen_files, with_lineage
from obslake.functions import day_and_time, is_missing, non_empty, number, whole_number
from obslake.operators import assess, quarantined, read_as
from obslake.operators.quality import STREAM_MAX_BYTES
from obslake.schema import HEADER, TYPES, snake_case


def evaluated(spark, sql, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in rows.coalesce(1).selectExpr(sql).collect()]


def test_numbers(spark):
    cases = {
        "15.8": 15.8, " -2 ": -2.0, "1e2": 100.0, ".5": 0.5, "-0.0": 0.0, "": None, None: None,
        "NaN": None, "nan": None, "Infinity": None, "-inf": None, "1e999": None, "12,5": None,
        "warm": None, "0x": None,
    }
    found = evaluated(spark, number("t"), list(cases))
    assert found == list(cases.values())
    assert "-0.0" not in [str(value) for value in found]


def test_whole_numbers(spark):
    cases = {
        "12": 12, "12.0": 12, "-3": -3, "2147483647": 2147483647, "2147483648": None,
        "12.5": None, "NaN": None, "Infinity": None, "NNE": None, "": None, None: None,
    }
    assert evaluated(spark, whole_number("t"), list(cases)) == list(cases.values())


def test_days(spark):
    cases = {
        "2016-02-01": "2016-02-01 00:00:00",
        "2016-02-01T13:45:10": "2016-02-01 13:45:10",
        "2016-02-01 13:45:10.5": "2016-02-01 13:45:10.5",
        "2016-02-01T13:45:10Z": "2016-02-01 13:45:10",
        "2016-13-01": None,
        "2016": None,
        "2016-02": None,
        "01/02/2016": "2016-02-01 00:00:00",
        "01/02/2016 10:00": "2016-02-01 10:00:00",
        "20160201": "2016-02-01 00:00:00",
        "20160201T13:45:10": "2016-02-01 13:45:10",
        "2016-02-01Z": "2016-02-01 00:00:00",
        "201602011": None,
        "201602": None,
        " 2016-02-01 ": "2016-02-01 00:00:00",
        "2016-2-1": "2016-02-01 00:00:00",
        "32/02/2016": None,
        "": None,
    }
    sql = f"CAST({day_and_time('t')} AS string)"
    assert evaluated(spark, sql, list(cases)) == list(cases.values())


def test_texts(spark):
    assert evaluated(spark, non_empty("t"), ["", "NA", " x ", None]) == [None, "NA", " x ", None]
    cases = {"": True, " ": True, "NA": True, " nan ": True, "#N/A": True, None: True, "NAN": False}
    assert evaluated(spark, is_missing("t"), list(cases)) == list(cases.values())


def test_names_of_columns():
    assert [snake_case(name) for name in HEADER] == list(TYPES)
    assert snake_case("SignificantWeatherCode") == "significant_weather_code"


def test_size_and_extension(spark):
    files = spark.createDataFrame(
        [
            ("a.csv", STREAM_MAX_BYTES - 1),
            ("b.csv", STREAM_MAX_BYTES),
            ("c.txt", STREAM_MAX_BYTES),
            ("d.csv.gz", 1),
        ],
        "filename string, length bigint",
    )
    extension = "Invalid file extension. Expected a CSV file."
    size = "File size 11000000 must be less than 11000000 bytes. Use Batch Process for this file."
    judged = screen_files(files, STREAM_MAX_BYTES).collect()
    assert {r.filename: (r.status, r.error) for r in judged} == {
        "a.csv": ("accepted", None),
        "b.csv": ("error", size),
        "c.txt": ("error", extension),
        "d.csv.gz": ("error", extension),
    }
    assert screen_files(files).where("status = 'accepted'").count() == 2


def test_every_row_is_kept_or_set_aside_and_every_flaw_named(spark, tmp_path):
    """Random fields against a plain reading of the rules."""
    rng = random.Random(11)
    good = {"double": ["1.5", "-3", ""], "int": ["7", "8.0", "NA"], "string": ["x", ""]}
    good["timestamp_ntz"] = ["2016-02-01", "2016-02-01T01:02:03", ""]
    bad = {"double": "warm", "int": "7.5", "timestamp_ntz": "soon"}
    lines, flaws, rejected = [], set(), 0
    for i in range(400):
        fields, wrong = {}, []
        for name in HEADER:
            column = snake_case(name)
            kind = TYPES[column]
            if kind in bad and rng.random() < 0.03:
                fields[name] = bad[kind]
                wrong.append(column)
            else:
                fields[name] = rng.choice(good[kind])
        fields["SiteName"] = f"row {i}"
        line = ",".join(fields[name] for name in HEADER)
        if rng.random() < 0.03:
            line, wrong = line + ",more", [None]
        flaws |= {(i, column) for column in wrong}
        rejected += bool({None, "observation_date", "screen_temperature"} & set(wrong))
        lines.append(line)
    path = write_csv(tmp_path, "a.csv", lines)
    rows = with_lineage(read_rows(spark, path), "BATCH", "2016-02-01")
    judged = assess(rows).collect()
    assert len(judged) == 400
    assert sum(r.is_rejected for r in judged) == rejected
    assert sum(r.is_flawed for r in judged) == len({i for i, _ in flaws})
    named = quarantined(rows).select(
        F.regexp_extract("raw", r"row (\d+)", 1).cast("int"), "column_name"
    )
    assert {tuple(r) for r in named.collect()} == flaws
    assert {r.raw for r in quarantined(rows).collect()} <= set(lines)


def test_inferred_types_do_not_depend_on_files_or_order(spark, tmp_path):
    values = {
        "WindSpeed": ["1", "-22", "", "NA"],
        "WindGust": ["1", "2.5", "", "7"],
        "Visibility": ["", "NaN", "null", ""],
        "Pressure": ["123456789012345678901", "5", "", "6"],
        "SignificantWeatherCode": ["true", "FALSE", "", "true"],
        "SiteName": ["2016-02-01", "7", "", "x"],
        "Region": ["2016-02-01", "20160202T10:00:00", "", "03/02/2016"],
        "Country": ["Infinity", "1", "", "2"],
    }
    rows = [row(i, **{name: texts[i] for name, texts in values.items()}) for i in range(4)]
    expected = {
        "wind_speed": "bigint", "wind_gust": "double", "visibility": "string",
        "pressure": "double", "significant_weather_code": "boolean", "site_name": "string",
        "region": "timestamp_ntz", "country": "string", "screen_temperature": "bigint",
        "observation_date": "timestamp_ntz", "latitude": "double",
    }
    seen = set()
    for cut in range(5):
        folder = tmp_path / str(cut)
        folder.mkdir()
        order = rows if cut % 2 else rows[::-1]
        write_csv(folder, "a.csv", order[:cut])
        write_csv(folder, "b.csv", order[cut:])
        typed = read_inferred(spark, str(folder))
        found = {field.name: field.dataType.simpleString() for field in typed.schema}
        assert {name: found[name] for name in expected} == expected
        seen.add(tuple(sorted(map(repr, typed.collect()))))
    assert len(seen) == 1
    second = [r for r in typed.collect() if r.wind_speed == -22][0]
    assert second.wind_gust == 2.5 and second.significant_weather_code is False
    assert str(second.region) == "2016-02-02 10:00:00" and second.pressure == 5.0


def test_inferred_types_of_no_rows_are_text(spark):
    empty = spark.createDataFrame([], "`a b` string, `c``d` string")
    types = infer_types(empty)
    assert [f.dataType.simpleString() for f in types] == ["string", "string"]
    odd = spark.createDataFrame([("1", None), (None, "x")], "`a b` string, `c``d` string")
    assert read_as(odd, infer_types(odd)).collect() == [(1, None), (None, "x")]
