"""The hottest row of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.text import day_text
from obslake.operators.measure import Measure


def stream_hottest(stream: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """The answer over everything a stream has brought so far, for output mode ``complete``.

    The state is one row. A maximum does not depend on order, so late rows
    count like any others and no watermark is set. Each task reduces its rows
    to one before they are shuffled.
    """
    hottest = stream.agg(F.min(measure.rank()).alias("row")).where(F.col("row").isNotNull())
    answer = [
        day_text(F.col(f"row.{measure.when}")).alias("hottest_date"),
        (-F.col("row.negative")).alias("max_value"),
        F.col(f"row.{measure.place}").alias("region"),
    ]
    if measure.country:
        answer.append(F.col(f"row.{measure.country}").alias("country"))
    return hottest.select(*answer)
