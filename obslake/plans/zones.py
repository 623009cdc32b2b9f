"""Extremes of the refined table that open only the loads which can hold them.

The answer log has the highest reading of every load. That is a zone map: the highest reading
of the table is the highest of the log, and the rows that hold it are in loads whose entry
is that high. Loads are partitions, so all others are pruned before a file is opened. A load
that has no entry yet, because its run is at work or was stopped, is read like a candidate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.operators.measure import Measure
from obslake.plans.lake import Lake, Load, loads_of, read_table

_KEYS = ["load_type", "load_dt"]


def lake_maximum(spark: SparkSession, lake: Lake, measure: Measure = Measure()) -> DataFrame:
    """One row: the highest reading of the refined table, null if there is none."""
    highest = read_table(spark, lake, "answer_log").select(F.col("temperature").alias("reading"))
    for load in _without_answers(spark, lake):
        rows = read_table(spark, lake, "observation", load)
        highest = highest.unionAll(rows.select(measure.reading.alias("reading")))
    return highest.agg(F.max("reading").alias("max_value"))


def lake_hottest_records(spark: SparkSession, lake: Lake, measure: Measure = Measure()) -> DataFrame:
    """All rows of the refined table that hold the highest reading."""
    highest = lake_maximum(spark, lake, measure).first()["max_value"]
    table = spark.table(lake.table("observation"))
    if highest is None:
        return table.where("false")
    # One row for each load that shares the maximum: their partitions are all that is read.
    log = read_table(spark, lake, "answer_log").where(F.col("temperature") == highest)
    holding = log.select(*_KEYS)
    open_loads = _without_answers(spark, lake)
    if open_loads:
        others = spark.createDataFrame([tuple(load) for load in open_loads], "load_type string, load_dt string")
        holding = holding.unionAll(others)
    return table.join(holding, _KEYS, "left_semi").where(F.col(measure.value) == highest).select(*table.columns)


def _without_answers(spark: SparkSession, lake: Lake) -> list[Load]:
    """Loads that the answer log does not know: those of runs at work, and of stopped ones."""
    return sorted(set(loads_of(spark, lake, "observation")) - set(loads_of(spark, lake, "answer_log")))
