"""Column -> Column helpers; all of them stay inside generated JVM code."""

from weirflow.functions.cleaning import (
    DATE_FORMATS,
    EVENT_TIMESTAMP_FORMAT,
    any_null,
    letters_upper,
    parse_date_any,
    parse_timestamp,
    repair_sign,
)
from weirflow.functions.derive import (
    duration_hms,
    duration_secs,
    month_number,
    month_text,
    surrogate_key,
    year_number,
)

__all__ = [
    "DATE_FORMATS",
    "EVENT_TIMESTAMP_FORMAT",
    "any_null",
    "duration_hms",
    "duration_secs",
    "letters_upper",
    "month_number",
    "month_text",
    "parse_date_any",
    "parse_timestamp",
    "repair_sign",
    "surrogate_key",
    "year_number",
]
