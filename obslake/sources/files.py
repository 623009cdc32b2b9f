"""File listings as DataFrames: names and sizes, never contents."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.text import last_segment

LISTING_SCHEMA = (
    "path string, file_uri string, filename string, length bigint, modified_ms bigint"
)

_BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def as_listing(files: DataFrame) -> DataFrame:
    """Listing columns of a binaryFile scan. The content column is pruned, so
    no file is opened. ``path`` is for readers; ``file_uri`` is the encoded
    form that file scans report for each row."""
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("file_uri"),
        last_segment(F.col("path")).alias("filename"),
        "length",
        F.unix_millis("modificationTime").alias("modified_ms"),
    )


def list_files(spark: SparkSession, directory: str, pattern: str | None = None) -> DataFrame:
    """Every non-empty file below a directory; no rows if there is no directory."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        files = reader.load(directory)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    # Zero-byte files are folder markers or unfinished uploads.
    return as_listing(files).where(F.col("length") > 0)


def list_incoming(spark: SparkSession, directory: str, limit: int | None = None) -> DataFrame:
    """The CSV files of a directory; with ``limit``, the first ones in path order.

    This is a listing and knows nothing of earlier runs: the same limit gives
    the same files again. ``batch_ingest`` leaves out what was loaded before.
    """
    files = list_files(spark, directory, "*.csv")
    return files if limit is None else files.orderBy("path").limit(limit)


def stream_files(
    spark: SparkSession,
    directory: str,
    max_files_per_trigger: int,
    max_file_age: str,
) -> DataFrame:
    """Arriving files as a stream of listing rows."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("maxFileAge", max_file_age)
    )
    return as_listing(reader.load(directory)).where(F.col("length") > 0)


def reader_paths(paths: Iterable[str]) -> list[str]:
    """Paths with glob characters escaped, since readers expand globs."""
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", path) for path in paths]
