"""Rows that came later than their time says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.operators.improvements import best_before, stored_maxima


def late_records(
    df: DataFrame,
    batch: str | Column,
    when: str = "observation_date",
    delay: str = "0 seconds",
    groups: int | None = None,
) -> DataFrame:
    """The rows that lie behind the watermark with which their batch began.

    The watermark of a batch is the latest time in all batches before it less ``delay``. Batches
    are taken in order of ``batch``; the first one has no watermark. Nothing is dropped: a late
    row is in the table and counts for every answer, and here it is named, with all its
    columns, ``batch``, ``watermark`` and ``late_by``, the interval that it is behind. Rows without
    a time are not late.

    The table is scanned twice: for the latest time of each batch, and for the late rows.
    No row at or after the highest watermark is late, which bounds the second scan.
    """
    batches = df.withColumn("batch", batch if isinstance(batch, Column) else F.col(batch))
    latest = best_before(*stored_maxima(batches, F.col(when), groups))
    marks = latest.where("best_before is not null").select(
        F.col("batch").alias("of_batch"),
        F.expr(f"best_before - INTERVAL {delay}").alias("watermark"),
    )
    highest = marks.select(F.max("watermark")).scalar()
    same_batch = F.col("batch").eqNullSafe(F.col("of_batch"))
    return (
        batches.where(F.col(when) < highest)
        .join(marks, same_batch & (F.col(when) < F.col("watermark")))
        .drop("of_batch")
        .withColumn("late_by", F.col("watermark") - F.col(when))
    )
