"""Shape of observation files and of the tables built from them."""

from __future__ import annotations

import re

# The header an observation file must carry, in order.
HEADER = [
    "ForecastSiteCode",
    "ObservationTime",
    "ObservationDate",
    "WindDirection",
    "WindSpeed",
    "WindGust",
    "Visibility",
    "ScreenTemperature",
    "Pressure",
    "SignificantWeatherCode",
    "SiteName",
    "Latitude",
    "Longitude",
    "Region",
    "Country",
]

# The three questions, used as keys of the answer table.
QUESTION_DATE = "Which date was the hottest day?"
QUESTION_TEMPERATURE = "What was the temperature on that day?"
QUESTION_REGION = "In which region was the hottest day?"

# How a load is labelled.
BATCH = "BATCH"
EVENT_DRIVEN = "EVENT-DRIVEN"

# Partitions of the ledger that are no loads: merged rows, and files handed back.
SNAPSHOT = "SNAPSHOT"
RETURNED = "RETURNED"


def snake_case(name: str) -> str:
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


COLUMNS = [snake_case(name) for name in HEADER]

_TYPES = {
    "observation_date": "timestamp_ntz",
    "screen_temperature": "double",
    "latitude": "double",
    "longitude": "double",
    "site_name": "string",
    "region": "string",
    "country": "string",
}

# Column -> Spark type; whatever is not listed above is a whole number.
TYPES = {column: _TYPES.get(column, "int") for column in COLUMNS}

CORRUPT = "_corrupt_record"

LINEAGE = ["filename", "load_type", "load_dt"]

# load_dt is ISO text in UTC. Text sorts by time, means the same in every
# session time zone, and is safe as a partition value.
OBSERVATION_SCHEMA = ", ".join(
    [f"{column} {kind}" for column, kind in TYPES.items()]
    + [f"{column} string" for column in LINEAGE]
)

QUARANTINE_SCHEMA = (
    "filename string, raw string, column_name string, reason string, row_kept boolean, "
    "load_type string, load_dt string"
)

LEDGER_SCHEMA = (
    "path string, file_uri string, filename string, length bigint, modified_ms bigint, "
    "batch_id string, status string, step string, error string, recorded_us bigint, "
    "load_type string, load_dt string"
)

FOLDER_SCHEMA = (
    "folder string, n_files bigint, digest_a bigint, digest_b bigint, recorded_us bigint, "
    "load_type string, load_dt string"
)

ANSWER_LOG_SCHEMA = (
    "batch_id string, temperature double, observed_at timestamp_ntz, region string, "
    "country string, load_type string, load_dt string"
)
