"""CSV scan of observation files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from obslake.operators.inference import infer_types, read_as
from obslake.operators.quality import to_canonical
from obslake.schema import COLUMNS, CORRUPT


def read_rows(
    spark: SparkSession,
    paths: str | list[str],
    multi_line: bool = False,
    header: bool = True,
    further: Sequence[str] = (),
) -> DataFrame:
    """All rows of all files in one scan, every field as text.

    A fixed schema means no pass to infer types. Doubled quotes inside a
    quoted field are one quote. Fields are taken by position, so screen
    headers first (``check_headers``). ``multi_line`` accepts line breaks
    inside quotes, at the price of files that cannot be split. With ``header=False``
    the header is a row like others. ``further`` names columns after the expected ones.
    """
    schema = ", ".join(f"`{name}` string" for name in [*COLUMNS, *further, CORRUPT])
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
        # A row with too few fields is only noticed where all of them are read.
        .option("columnPruning", not further)
        .csv(paths)
    )


def read_observations(
    spark: SparkSession, paths: str | list[str], multi_line: bool = False
) -> DataFrame:
    """Observation files as typed rows; fields that do not parse are null."""
    return to_canonical(read_rows(spark, paths, multi_line))


def read_inferred(
    spark: SparkSession, paths: str | list[str], multi_line: bool = False
) -> DataFrame:
    """Observation files with the types that all their values have in common.

    Two passes over the files: one for the types, one when the rows are used.
    """
    rows = read_rows(spark, paths, multi_line).drop(CORRUPT)
    return read_as(rows, infer_types(rows))
