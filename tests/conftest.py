from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from obslake import Lake, build_session
from obslake.schema import HEADER


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "4",
        spark__sql__warehouse__dir=str(warehouse),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


_counter = iter(range(10_000))


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(str(tmp_path / "lake"), f"obs_test_{next(_counter)}")
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS {made.database} CASCADE")


@pytest.fixture
def incoming(tmp_path):
    folder = tmp_path / "incoming"
    folder.mkdir()
    return folder


def row(temperature, date="2016-02-01T00:00:00", region="Wales", hour=12, site=3001, **other):
    """One CSV line of an observation file."""
    values = {
        "ForecastSiteCode": site,
        "ObservationTime": hour,
        "ObservationDate": date,
        "WindDirection": 8,
        "WindSpeed": 10,
        "WindGust": "",
        "Visibility": 30000,
        "ScreenTemperature": temperature,
        "Pressure": 1013,
        "SignificantWeatherCode": 7,
        "SiteName": "A SITE",
        "Latitude": 51.5,
        "Longitude": -3.2,
        "Region": region,
        "Country": "WALES",
        **other,
    }
    return ",".join(str(values[name]) for name in HEADER)


def write_csv(folder, name, rows, header=None):
    path = folder / name
    lines = [",".join(header or HEADER), *rows]
    path.write_text("\n".join(lines) + "\n")
    return str(path)
