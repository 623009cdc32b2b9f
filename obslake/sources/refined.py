"""Reading what was loaded."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_refined(spark: SparkSession, path: str) -> DataFrame:
    """A refined Parquet folder, by path."""
    return spark.read.parquet(path)


def query_refined(spark: SparkSession, sql: str, **frames: Any) -> DataFrame:
    """Ad-hoc SQL over catalog tables, or over DataFrames named in braces."""
    return spark.sql(sql, **frames)
