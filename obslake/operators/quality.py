"""Checks on files and rows."""

from __future__ import annotations

import csv
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.parsing import (
    day_and_time,
    invalid,
    is_missing,
    non_empty,
    number,
    whole_number,
)
from obslake.schema import COLUMNS, CORRUPT, HEADER, LINEAGE, TYPES

# The messages of the checks, and the size a streamed file must stay below.
INVALID_EXTENSION = "Invalid file extension. Expected a CSV file."
INVALID_SIZE = "File size %s must be less than %s bytes. Use Batch Process for this file."
INVALID_COLUMNS = "Invalid columns."
STREAM_MAX_BYTES = 11_000_000

_PARSERS = {
    "double": number,
    "int": whole_number,
    "timestamp_ntz": day_and_time,
    "string": non_empty,
}
_REASONS = {
    "double": "invalid number",
    "int": "invalid number",
    "timestamp_ntz": "invalid timestamp",
}

# Without these two a row cannot answer anything, so a row where one of them
# is not readable is set aside. Elsewhere only the field is lost, and noted.
ESSENTIAL = ["observation_date", "screen_temperature"]

_PARSED = [name for name in COLUMNS if TYPES[name] in _REASONS]

# Writes a row's fields back as the CSV reader took them.
_AS_READ = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def screen_files(files: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Judge files by name and size: adds ``status`` and ``error``.

    Refused files stay in the frame, so that they can be recorded.
    """
    error = F.when(~F.col("filename").endswith(".csv"), F.lit(INVALID_EXTENSION))
    if max_bytes is not None:
        message = F.format_string(
            INVALID_SIZE, F.col("length").cast("string"), F.lit(str(max_bytes))
        )
        error = error.when(F.col("length") >= max_bytes, message)
    judged = files.withColumn("error", error)
    accepted = F.col("error").isNull()
    return judged.withColumn("status", F.when(accepted, "accepted").otherwise("error"))


def check_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Per file (``file_uri``): is its first line exactly the expected header?

    Names, order and case must match; each name may be quoted. Blank lines at
    the top and a byte-order mark are passed over, as by the CSV reader.

    The first line of a file is the one with the lowest id in its first
    block, so it is enough to compare the lowest id of all lines with the
    lowest id of the lines that look like the header. Both are numbers: the
    aggregate is hashed, reduced to one row per file inside each task, and no
    line of text is sorted or shuffled. A file without lines has no row.
    """
    names = ",".join(f'(?:{name}|"{name}")' for name in HEADER)
    line = F.col("value")
    # The cheap test first: almost every line fails it.
    starts = line.startswith(HEADER[0]) | line.startswith(f'"{HEADER[0]}')
    lines = (
        spark.read.text(paths)
        .where((F.col("_metadata.file_block_start") == 0) & (F.length(F.trim(line)) > 0))
        .select(
            F.col("_metadata.file_path").alias("file_uri"),
            F.monotonically_increasing_id().alias("line_id"),
            (starts & line.rlike(f"^{names}$")).alias("is_header"),
        )
    )
    first_line = F.min("line_id")
    first_header = F.min(F.when(F.col("is_header"), F.col("line_id")))
    return lines.groupBy("file_uri").agg(
        F.coalesce(first_line == first_header, F.lit(False)).alias("header_ok")
    )


def read_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The first line of each file (``file_uri``, ``header``) that is not blank."""
    line_id = F.monotonically_increasing_id()
    lines = (
        spark.read.text(paths)
        .where((F.col("_metadata.file_block_start") == 0) & (F.length(F.trim("value")) > 0))
        .select(F.col("_metadata.file_path").alias("file_uri"), "value", line_id.alias("line_id"))
    )
    return lines.groupBy("file_uri").agg(F.min_by("value", "line_id").alias("header"))


def further_columns(header: str) -> list[str] | None:
    """The columns that a header has after the expected ones, as the table names them; None if
    it does not begin with these, or goes on with what cannot be the name of a column."""
    names = next(csv.reader([header]))
    if names[: len(HEADER)] != HEADER:
        return None
    words = [re.sub("(?<=[a-z0-9])(?=[A-Z])", "_", name.strip()) for name in names[len(HEADER) :]]
    found = [re.sub(r"\W+", "_", word).lower() for word in words]
    taken = {*COLUMNS, *LINEAGE}
    fit = len(set(found)) == len(found) and not taken & set(found)
    return found if fit and all(name[:1] not in ("", "_") for name in found) else None


def mark_first_lines(rows: DataFrame) -> DataFrame:
    """Adds ``header_of``: the file, if the row is the first one of its task, at the beginning of
    a file, and is exactly the expected header; else null.

    For scans that take headers as rows and have a task for each split of a file: there, the
    first row of the split at the beginning is the file's first line.
    """
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first = (F.col("_metadata.file_block_start") == 0) & (in_task == 0)
    # As one text: a comparison for each field would outgrow what the JVM compiles.
    as_read = F.to_csv(F.struct(*COLUMNS), _AS_READ)
    is_header = first & F.col(CORRUPT).isNull() & (as_read == ",".join(HEADER))
    return rows.withColumn("header_of", F.when(is_header, F.col("_metadata.file_path")))


def to_canonical(rows: DataFrame) -> DataFrame:
    """Text rows to typed rows; further columns (lineage) are kept."""
    return rows.selectExpr(*[f"{_typed(name)} AS {name}" for name in COLUMNS], *_extra(rows))


def assess(rows: DataFrame) -> DataFrame:
    """Typed rows with two flags: ``is_rejected``, the row must be set aside,
    and ``is_flawed``, it has something to report."""
    return _text_and_typed(rows).selectExpr(
        *[f"typed_{name} AS {name}" for name in COLUMNS],
        *_extra(rows),
        f"{_any_unreadable(ESSENTIAL)} AS is_rejected",
        f"{_any_unreadable(_PARSED)} AS is_flawed",
    )


def quarantined(rows: DataFrame) -> DataFrame:
    """One row per flaw of a text row: the row's text, the column, the reason,
    and whether the row was kept (with that field null) or set aside."""
    flaws = [f"CASE WHEN {_MALFORMED} THEN {_flaw('string(NULL)', 'malformed row')} END"]
    for name in _PARSED:
        found = f"NOT {_MALFORMED} AND {_unreadable(name)}"
        flaw = _flaw(f"'{name}'", _REASONS[TYPES[name]])
        flaws.append(f"CASE WHEN {found} THEN {flaw} END")
    # Not a filter: it would be moved in front of the parsing and repeat it.
    listed = f"array_compact(array({', '.join(flaws)}))"
    found = f"CASE WHEN {_any_unreadable(_PARSED)} THEN {listed} END"
    extra = _extra(rows)
    return (
        _text_and_typed(rows)
        .select(
            F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*COLUMNS), _AS_READ)).alias("raw"),
            F.expr(f"NOT {_any_unreadable(ESSENTIAL)}").alias("row_kept"),
            F.expr(f"explode({found})").alias("flaw"),
            *extra,
        )
        .select("raw", "flaw.column_name", "flaw.reason", "row_kept", *extra)
    )


_MALFORMED = f"({CORRUPT} IS NOT NULL)"


def _extra(rows: DataFrame) -> list[str]:
    return [f"`{name}`" for name in rows.columns if name not in COLUMNS and name != CORRUPT]


def _typed(name: str) -> str:
    return _PARSERS[TYPES[name]](name)


def _text_and_typed(rows: DataFrame) -> DataFrame:
    """Each value parsed once, for all conditions that look at it."""
    return rows.selectExpr("*", *[f"{_typed(name)} AS typed_{name}" for name in COLUMNS])


def _unreadable(name: str) -> str:
    return f"(typed_{name} IS NULL AND NOT {is_missing(name)})"


def _any_unreadable(names: list[str]) -> str:
    """The row is malformed, or one of these fields does not parse."""
    return f"({_MALFORMED} OR {invalid({name: f'typed_{name}' for name in names})})"


def _flaw(column: str, reason: str) -> str:
    return f"named_struct('column_name', {column}, 'reason', '{reason}')"
