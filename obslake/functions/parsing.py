"""Text to typed values, as SQL expressions over a text column.

Nothing here raises on bad text: it yields null.
"""

from __future__ import annotations

import re

# The texts a default pandas CSV reader takes as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def number(column: str) -> str:
    """A finite double, else null.

    NaN would rank above every reading and infinity would hold the maximum
    for ever, so neither gets through (NaN compares as above infinity).
    Adding 0 turns -0.0 into 0.0, so that equal readings stay equal for
    Parquet's own filters too.
    """
    value = f"try_cast({column} AS double)"
    finite = f"abs({value}) < double('Infinity')"
    return f"CASE WHEN {finite} AND NOT {_is_literal(column)} THEN {value} + 0D END"


def whole_number(column: str) -> str:
    """A 32-bit integer, also from ``12.0``, which a float column leaves behind."""
    value = f"try_cast({column} AS double)"
    whole = f"try_cast({value} AS int)"
    return f"CASE WHEN {whole} = {value} AND NOT {_is_literal(column)} THEN {whole} END"


def _is_literal(column: str) -> str:
    """Whether a text that casts to a double has letters that only program text
    has: a type suffix (``15.8F``, ``12d``) or a hexadecimal form (``0x1p3``)."""
    return f"{column} RLIKE '[dDfFxX]'"


def day_and_time(column: str) -> str:
    """A wall-clock timestamp; no time zone is applied.

    The day is read from ``2016-02-01``, ``20160201`` or ``01/02/2016`` (day first),
    with or without a time. A text without a day (``2016``, ``2016-02``) is none.
    """
    day = f"regexp_replace({column}, {_DAY}, '$3$4-$2$5-$1$6')"
    return f"try_cast({day} AS timestamp_ntz)"


def non_empty(column: str) -> str:
    return f"nullif({column}, '')"


def is_missing(column: str) -> str:
    return f"({column} IS NULL OR {column} RLIKE r'^(?:{_MISSING})$')"


def invalid(columns: dict[str, str]) -> str:
    """Is any of these text columns (keys) neither parsed (values) nor missing?

    The texts that did not parse are strung together, which is mostly the
    empty string, and matched at once. A test per column would be shorter to
    write, but the code generated for it outgrows what the JVM compiles.
    """
    left = ", ".join(f"CASE WHEN {typed} IS NULL THEN {raw} END" for raw, typed in columns.items())
    unread = f"concat_ws('{_SEPARATOR}', {left})"
    all_missing = f"^(?:{_MISSING})(?:{_SEPARATOR}(?:{_MISSING}))*$"
    return f"({unread} <> '' AND NOT {unread} RLIKE r'{all_missing}')"


# Day first, year first, or no day, of which nothing stays that could be read; then a time
# or at most the mark of a zone.
_DAY = (
    r"r'^\s*(?:(\d{2})/(\d{2})/(\d{4})|(\d{4})-?(\d{2})-?(\d{2})|\d{4,7}(?:-\d{1,2})?\s*$)"
    r"(?:Z$|(?!\d))'"
)

_SEPARATOR = "\x1f"

_MISSING = r"\s*(?:" + "|".join(re.escape(missing) for missing in MISSING_TEXTS) + r")\s*"
