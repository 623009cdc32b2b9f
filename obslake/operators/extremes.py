"""The highest reading of a table and the row it stands in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.text import day_text
from obslake.operators.measure import Measure


def max_temperature(df: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """One row: the highest reading, null if there is none."""
    return df.agg(F.max(measure.reading).alias("max_value"))


def hottest_records(df: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """All rows that hold the highest reading, with all their columns.

    The maximum is a scalar subquery. It reads one column, and its result is
    pushed into the second Parquet scan, which then skips every row group
    whose statistics lie below it. Nothing but partial maxima is shuffled.
    """
    highest = df.select(F.max(measure.reading)).scalar()
    return df.where(F.col(measure.value) == highest)


def top_reading(df: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """The one hottest row: value, time, place and tie-break columns.

    Only rows at the maximum are sorted, and each task keeps one of them, so
    a maximum shared by a great part of the rows does no harm.
    """
    columns = dict.fromkeys([measure.value, *measure.payload])
    return hottest_records(df, measure).select(*columns).orderBy(*measure.order).limit(1)


def hottest_answer(df: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """Day, highest value and region (and country, if there is one), all from one row."""
    answer = [
        day_text(F.col(measure.when)).alias("hottest_date"),
        F.col(measure.value).alias("max_value"),
        F.col(measure.place).alias("region"),
    ]
    if measure.country:
        answer.append(F.col(measure.country).alias("country"))
    return top_reading(df, measure).select(*answer)
