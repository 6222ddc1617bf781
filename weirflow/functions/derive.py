"""Columns derived from trips and other timed facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirflow.functions.cleaning import _col


def year_number(c: Column | str) -> Column:
    return F.year(F.to_date(_col(c)))


def month_number(c: Column | str) -> Column:
    """Month as int, the type a ``month=`` directory is read back with."""
    return F.month(F.to_date(_col(c)))


def month_text(c: Column | str) -> Column:
    """Month as zero-padded text."""
    return F.date_format(_col(c), "MM")


def duration_secs(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end; each side is floored to its second.

    Times without a zone are compared by their own clock, whatever the zone of
    the session is.
    """
    return _whole_seconds(_col(end)) - _whole_seconds(_col(start))


def _whole_seconds(time: Column) -> Column:
    days = F.datediff(F.to_date(time), F.lit("1970-01-01").cast("date")).cast("long")
    clock = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    instant = time.cast("timestamp").cast("long")
    # The type is known to the optimizer, which keeps one of the two.
    return F.when(F.typeof(time) == "timestamp_ntz", days * 86_400 + clock).otherwise(instant)


def duration_hms(seconds: Column | str) -> Column:
    """``HH:MM:SS`` text. Hours may pass 99, each part of a negative duration
    carries its own sign, and a null duration prints as the text null."""
    secs = _col(seconds)
    hours, rest = _div(secs, 3600), secs % 3600
    return F.format_string("%02d:%02d:%02d", hours, _div(rest, 60), rest % 60)


def _div(value: Column, unit: int) -> Column:
    return F.call_function("div", value, F.lit(unit))


def surrogate_key(*columns: Column | str, null_as: str | None = None) -> Column:
    """MD5 over the ``|``-joined columns.

    A null is skipped together with its separator unless ``null_as`` gives a
    text to stand in for it (which keeps (a, null, b) and (a, b) apart).
    """
    parts = [_col(c).cast("string") for c in columns]
    if null_as is not None:
        parts = [F.coalesce(p, F.lit(null_as)) for p in parts]
    return F.md5(F.concat_ws("|", *parts))
