"""Scalar cleaning rules."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date formats (first match wins) and event time format.
DATE_FORMATS = ("yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy")
EVENT_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
# Fixed value: everything that is not a letter.
NOT_A_LETTER = "[^a-zA-Z]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Text that a pattern letter group can stand for, for the groups used above.
_SHAPES = {"yyyy": r"[+-]?\d{4,}", "MM": r"\d{2}", "dd": r"\d{2}"}


def _shape(fmt: str) -> str:
    """A regex that every text of the date format matches."""
    groups = re.split("(yyyy|MM|dd)", fmt)
    return "^" + "".join(_SHAPES.get(g, re.escape(g)) for g in groups) + "$"


def parse_date_any(c: Column | str, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """The date by the first format that parses, null when none does.

    A failed parse costs an exception, so a format is only tried on text of its
    shape; the parse itself stays strict.
    """
    text = _col(c)
    tries = [F.when(text.rlike(_shape(fmt)), F.try_to_date(text, fmt)) for fmt in formats]
    return F.coalesce(*tries)


def parse_timestamp(c: Column | str, fmt: str = EVENT_TIMESTAMP_FORMAT) -> Column:
    """A strict parse: text in any other shape becomes null, never an error."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def letters_upper(c: Column | str) -> Column:
    """``log_in 2`` -> ``LOGIN``."""
    return F.upper(F.regexp_replace(_col(c), NOT_A_LETTER, ""))


def repair_sign(c: Column | str) -> Column:
    """A negative amount is a sign error to repair, not a reject."""
    return F.abs(_col(c))


def any_null(columns: Iterable[str]) -> Column:
    """True where at least one of the columns is null; never null itself."""
    return reduce(or_, [F.col(f"`{name}`").isNull() for name in columns])
