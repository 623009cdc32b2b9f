"""Days and file names as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_text(when: Column) -> Column:
    """The day as ``2016-02-01``: the first ten characters of an ISO time."""
    return F.date_format(when, "yyyy-MM-dd")


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def decoded(name: Column) -> Column:
    """A file name as it is, from the percent-encoded form that file scans report.

    A plus sign stands for itself there, unlike in web forms.
    """
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
