"""Unions of observation frames. Neither removes duplicates, neither shuffles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name; a missing column is null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def union_by_position(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by position under the first frame's names.

    With columns in another order, values end up under wrong names without an
    error. Loading does not use it: all files of a run are one scan there.
    """
    return reduce(DataFrame.unionAll, frames)
