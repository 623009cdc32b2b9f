"""The types that the texts of a table can be read as."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from obslake.functions.parsing import day_and_time, is_missing, number

#: From the narrowest to the widest. Every text can be read as the last one.
TYPES = ["bigint", "double", "timestamp_ntz", "boolean", "string"]

_EVERY = (1 << len(TYPES)) - 1
_TEXT = 1 << (len(TYPES) - 1)


def infer_types(rows: DataFrame) -> StructType:
    """The narrowest type that holds all values of each text column.

    One pass. A value gives the set of types that it can be read as, and a column has what
    all its values have in common. That does not depend on how the rows are cut into files and
    tasks, or on their order, and missing values (``MISSING_TEXTS``) have all types in common, so
    an empty column in some file changes nothing. A column without any value is text.

    Whole numbers have at most 18 digits; longer ones are doubles, and a column of
    whole and other numbers is one of doubles. Numbers are finite, days are read like
    observation dates; numbers and days in one column are text.
    """
    names = rows.columns
    plain = rows.toDF(*[f"c{i}" for i in range(len(names))])
    common = plain.agg(
        *[F.expr(f"bit_and({_readable_as(f'c{i}')})").alias(f"c{i}") for i in range(len(names))]
    ).first()
    return StructType([StructField(name, _narrowest(mask)) for name, mask in zip(names, common)])


def read_as(rows: DataFrame, types: StructType) -> DataFrame:
    """Text columns as these types; what is missing, or does not fit, is null."""
    parsers = {
        "bigint": lambda c: f"try_cast(trim({c}) AS bigint)",
        "double": number,
        "timestamp_ntz": day_and_time,
        "boolean": lambda c: f"try_cast(trim({c}) AS boolean)",
        "string": lambda c: c,
    }
    return rows.selectExpr(
        *[
            f"CASE WHEN NOT {is_missing(quoted)} THEN {parsers[kind](quoted)} END AS {quoted}"
            for quoted, kind in (
                (f"`{field.name.replace('`', '``')}`", field.dataType.simpleString())
                for field in types
            )
        ]
    )


def _readable_as(column: str) -> str:
    """The types of a value as a set of bits."""
    fits = {
        "bigint": rf"trim({column}) RLIKE r'^[+-]?\d{{1,18}}$'",
        "double": f"{number(column)} IS NOT NULL",
        "timestamp_ntz": f"{day_and_time(column)} IS NOT NULL",
        "boolean": f"lower(trim({column})) IN ('true', 'false')",
    }
    bits = " + ".join(
        f"CASE WHEN {condition} THEN {1 << TYPES.index(kind)} ELSE 0 END"
        for kind, condition in fits.items()
    )
    return f"CASE WHEN {is_missing(column)} THEN {_EVERY} ELSE {bits} + {_TEXT} END"


def _narrowest(mask: int | None):
    kinds = [kind for i, kind in enumerate(TYPES) if mask and mask >> i & 1]
    # All types in common means that there was no value.
    chosen = kinds[0] if kinds and mask != _EVERY else "string"
    return _parse_datatype_string(chosen)
