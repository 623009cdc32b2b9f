"""A running maximum over batches, with the row behind each new maximum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obslake.functions.text import day_text
from obslake.operators.measure import Measure
from obslake.session import work_dir

#: Batches in one window.
PER_RANGE = 10_000


def running_answer_log(
    df: DataFrame,
    batch: str | Column,
    measure: Measure = Measure(),
    initial: float | None = 0.0,
    groups: int | None = None,
) -> DataFrame:
    """One row for each batch that raised the answer, batches taken in order of ``batch``.

    A batch counts if its maximum is strictly above ``initial`` and above the
    maxima of all batches before it; with an equal reading the earlier batch
    stays. ``initial=None`` lets any first reading count.

    1. The maximum per batch: a hash aggregate over two columns, written once to the shared
       folder of the cluster. All that follows but the last step works on these few rows.
    2. The batches that improve on all earlier ones. The batches are dealt into
       ranges of some PER_RANGE, ``groups`` at most (by default as many as a shuffle has
       partitions), each with a window of its own that starts from the maximum of the ranges
       before it. Only one row per range is ever in one task. The bounds are
       batches drawn by their hashes: they spread the work, and any bounds
       give the same rows.
    3. The rows behind them, in the second and last scan of the table. No row below the lowest
       improving maximum can be one, and that bound is pushed into the scan as a scalar
       subquery. An equi-join leaves the rows that have their batch's maximum, so only
       these are ranked.
    """
    batches = df.withColumn("batch", batch if isinstance(batch, Column) else F.col(batch))
    improving = _improving(*stored_maxima(batches, measure.reading, groups), initial)

    floor = improving.select(F.min("max_value")).scalar()
    top = improving.select(F.col("batch").alias("top_batch"), F.col("max_value").alias("top_value"))
    same_batch = F.col("batch").eqNullSafe(F.col("top_batch"))
    winners = (
        batches.where(F.col(measure.value) >= floor)
        .withColumn("reading", measure.reading)
        .join(top, same_batch & (F.col("reading") == F.col("top_value")))
        .groupBy("batch", F.col("top_value").alias("max_value"))
        .agg(F.min(measure.rank()).alias("row"))
    )
    answer = [
        "batch",
        "max_value",
        day_text(F.col(f"row.{measure.when}")).alias("hottest_date"),
        F.col(f"row.{measure.place}").alias("region"),
    ]
    if measure.country:
        answer.append(F.col(f"row.{measure.country}").alias("country"))
    return winners.select(*answer)


def _improving(maxima: DataFrame, groups: int, initial: float | None) -> DataFrame:
    value, best = F.col("max_value"), F.col("best_before")
    if initial is not None:
        best = F.greatest(best, F.lit(initial))
    beats = F.coalesce(value > best, value.isNotNull())  # nothing to beat yet
    before = best_before(maxima, groups).withColumn("beats", beats)
    return before.where("beats").select("batch", "max_value")


def best_before(maxima: DataFrame, groups: int) -> DataFrame:
    """Adds ``best_before``, the maximum of all earlier batches, to (batch, max_value).

    With more than one group, batches are dealt into ranges, and a window over everything
    has a row for each range only.
    """
    if groups <= 1:
        earlier = W.orderBy("batch").rowsBetween(W.unboundedPreceding, -1)
        return maxima.withColumn("best_before", F.max("max_value").over(earlier))
    drawn = maxima.where("batch is not null").orderBy(F.xxhash64("batch"), "batch").limit(groups - 1)
    bounds = drawn.select(F.collect_list("batch")).scalar()
    # A null batch is the first of all, and lies above no bound.
    below = F.filter("bounds", lambda bound: bound <= F.col("batch"))
    dealt = maxima.withColumn("bounds", bounds).withColumn("range", F.size(below)).drop("bounds")
    per_range = dealt.groupBy("range").agg(F.max("max_value").alias("range_max"))
    preceding = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    before = per_range.select(
        F.col("range").alias("of_range"), F.max("range_max").over(preceding).alias("before")
    )
    earlier = W.partitionBy("range").orderBy("batch").rowsBetween(W.unboundedPreceding, -1)
    best = F.greatest(F.max("max_value").over(earlier), "before")
    dealt = dealt.join(before, F.col("range") == F.col("of_range"))
    return dealt.withColumn("best_before", best).select(*maxima.columns, "best_before")


def stored_maxima(batches: DataFrame, value: Column, groups: int | None) -> tuple[DataFrame, int]:
    """(batch, max_value) of a table with a column ``batch``, written to the shared folder, and
    into how many ranges to deal them."""
    spark = batches.sparkSession
    if groups is None:
        groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = Observation()
    path = work_dir(spark, "maxima")
    maxima = batches.groupBy("batch").agg(F.max(value).alias("max_value"))
    maxima.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    ranges = min(groups, -(-seen.get["n"] // PER_RANGE))
    return spark.read.schema(maxima.schema).parquet(path), ranges
