from obslake.functions.parsing import (
    MISSING_TEXTS,
    day_and_time,
    invalid,
    is_missing,
    non_empty,
    number,
    whole_number,
)
from obslake.functions.text import day_text, decoded, last_segment

__all__ = [
    "MISSING_TEXTS",
    "day_and_time",
    "day_text",
    "decoded",
    "invalid",
    "is_missing",
    "last_segment",
    "non_empty",
    "number",
    "whole_number",
]
