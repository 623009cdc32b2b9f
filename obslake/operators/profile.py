"""Summary of a table's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: type, row count and count of non-null values, in one pass.

    A single aggregate without grouping keys; each task sends one row.
    """
    columns = columns or df.columns
    kinds = {field.name: field.dataType.simpleString() for field in df.schema}
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(f"`{name}`")).alias(f"n_{i}") for i, name in enumerate(columns)],
    )
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kinds[name]).alias("dtype"),
            F.col("n_rows"),
            F.col(f"n_{i}").alias("n_non_null"),
        )
        for i, name in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*rows)))
