"""A stream of the answers as they rise."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from obslake.operators.measure import Measure

# The state's set-up runs in a Python process that files added to the session do not reach, so
# what this module sends to tasks goes there whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_improvements(
    stream: DataFrame, measure: Measure = Measure(), initial: float | None = 0.0
) -> DataFrame:
    """A row each time a micro-batch raises the answer, for output mode ``append``.

    ``place_in_log`` counts the rows from 1. A micro-batch counts if its highest reading is
    strictly above ``initial`` and above all micro-batches before it, also before a restart: with
    micro-batches for batches, the rows are those of ``running_answer_log``. Late rows
    count like any others.

    Each task reduces its rows to one before anything is shuffled, so the one group that they
    meet in gets a row for each task. The state is two numbers. The session needs the
    RocksDB state store (``ROCKSDB`` as spark.sql.streaming.stateStore.providerClass).
    """
    if stream.sparkSession.conf.get(_PROVIDER, "") != ROCKSDB:
        raise ValueError(f"{_PROVIDER} must be {ROCKSDB}")
    rows = stream.select(*_columns(measure)).where(F.col("reading").isNotNull())
    order = [name for name in rows.columns if name.startswith("by_")]

    def hottest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: pa.Table | None = None
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                best = _first(table if best is None else pa.concat_tables([best, table]), order)
        if best is not None:
            yield from best.to_batches()

    # A row for each task: the first of its hottest ones.
    tops = rows.mapInArrow(hottest, rows.schema)
    answer = "hottest_date string, max_value double, region string"
    if measure.country:
        answer += ", country string"
    return (
        tops.withColumn("all", F.lit(0))
        .groupBy("all")
        .transformWithStateInPandas(
            statefulProcessor=_Rising(order, initial, bool(measure.country)),
            outputStructType=f"place_in_log bigint, {answer}",
            outputMode="Append",
            timeMode="None",
        )
    )


def _columns(measure: Measure) -> list[Column]:
    """The reading, the answer, and what decides between equal readings, in its order.

    Times are taken as their ISO text, which sorts alike and has no bounds in pandas.
    """
    when = F.col(measure.when).cast("string")
    ties = [name for name in measure.payload if name != measure.when]
    return [
        measure.reading.cast("double").alias("reading"),
        F.left(when, F.lit(10)).alias("day"),
        F.col(measure.place).cast("string").alias("region"),
        (F.col(measure.country) if measure.country else F.lit(None)).cast("string").alias("country"),
        when.alias("by_when"),
        *[F.col(name).alias(f"by_{i}_{name}") for i, name in enumerate(ties)],
    ]


def _first(rows: pa.Table, order: list[str]) -> pa.Table:
    """The hottest row, the first of them in this order, nulls last."""
    tops = rows.filter(pc.equal(rows["reading"], pc.max(rows["reading"])))
    keys = [(name, "ascending") for name in order]
    return tops.take(pc.sort_indices(tops, sort_keys=keys, null_placement="at_end")[:1])


class _Rising(StatefulProcessor):
    """Keeps the highest reading so far, and how often it has risen."""

    def __init__(self, order: list[str], initial: float | None, country: bool):
        self._order, self._initial, self._country = order, initial, country

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._so_far = handle.getValueState("so_far", "reading double, n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):  # noqa: N802, N803
        tables = [pa.Table.from_pandas(part, preserve_index=False) for part in rows]
        top = _first(pa.concat_tables(tables, promote_options="permissive"), self._order).to_pylist()[0]
        known = self._so_far.get() if self._so_far.exists() else (self._initial, 0)
        if known[0] is None or top["reading"] > known[0]:
            n = int(known[1]) + 1
            self._so_far.update((top["reading"], n))
            answer = {
                "place_in_log": [n],
                "hottest_date": [top["day"]],
                "max_value": [top["reading"]],
                "region": [top["region"]],
            }
            if self._country:
                answer["country"] = [top["country"]]
            yield pd.DataFrame(answer)

    def close(self) -> None:
        pass
