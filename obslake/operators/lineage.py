"""Where a row came from."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.text import decoded


def utc_stamp() -> str:
    """Now in UTC as ISO text of fixed width, so that text order is time order."""
    return datetime.now(UTC).replace(tzinfo=None).isoformat(timespec="microseconds")


def with_lineage(scan: DataFrame, load_type: str, load_dt: str) -> DataFrame:
    """Add ``filename``, ``load_type`` and ``load_dt`` to a file scan.

    The file name is the scan's own metadata, so one scan of many files is
    enough and each row still names its file.
    """
    return scan.withColumns(
        {
            "filename": decoded(F.col("_metadata.file_name")),
            "load_type": F.lit(load_type),
            "load_dt": F.lit(load_dt),
        }
    )
