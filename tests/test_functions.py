import datetime as dt

import pytest
from pyspark.sql import functions as F

from weirflow.functions import (
    DATE_FORMATS,
    any_null,
    duration_hms,
    duration_secs,
    letters_upper,
    month_number,
    month_text,
    parse_date_any,
    parse_timestamp,
    repair_sign,
    surrogate_key,
    year_number,
)


def value(spark, column, **fields):
    row = spark.sql("SELECT 1 AS one")
    for name, field in fields.items():
        row = row.withColumn(name, F.lit(field))
    return row.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2023-07-10", dt.date(2023, 7, 10)),
        ("13-07-2023", dt.date(2023, 7, 13)),
        ("13/07/2023", dt.date(2023, 7, 13)),
        ("2023-7-1", None),
        ("31-02-2023", None),
        ("2023-07-10 trailing", None),
        ("bogus", None),
        (None, None),
    ],
)
def test_dates_parse_strictly_in_three_formats(spark, text, expected):
    assert value(spark, parse_date_any(F.col("t").cast("string")), t=text) == expected


def test_shape_check_never_changes_a_parse(spark):
    """Brute force over near misses: the same dates as trying every format."""
    years = ["2023", "0023", "23", "12023", "+12023", "-2023", "+2023", "99999"]
    days = ["01", "1", "29", "31", "00", "011", " 1", "\u0661\u0661"]
    texts = [f"{y}-{m}-{d}" for y in years for m in ("02", "2", "13") for d in days]
    texts += [f"{d}{s}{m}{s}{y}" for y in years for m in ("02", "12") for d in days for s in "-/"]
    texts += [t + tail for t in ("2023-02-01", "01/02/2023") for tail in ("\n", " ", "x", "T00:00")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.try_to_date("t", fmt) for fmt in DATE_FORMATS])
    differ = df.where(~parse_date_any("t").eqNullSafe(plain))
    assert [r["t"] for r in differ.collect()] == []
    assert df.where(parse_date_any("t").isNotNull()).count() > 10


@pytest.mark.parametrize(
    "text, hour",
    [
        ("2023-07-10T10:01:00Z", 10),
        ("2023-07-10T10:01:00+03", 7),
        ("2023-07-10T10:01:00+0300", 7),
        ("2023-07-10T10:01:00+03:00", None),
        ("2023-07-10T10:01:00.5Z", None),
        ("2023-07-10 10:01:00Z", None),
        ("invalid_timestamp", None),
    ],
)
def test_event_timestamps_shift_to_utc_or_are_null(spark, text, hour):
    assert value(spark, F.hour(parse_timestamp("t")), t=text) == hour


def test_codes_keep_letters_only(spark):
    assert value(spark, letters_upper("t"), t="log_in 2") == "LOGIN"


def test_sign_is_repaired(spark):
    assert value(spark, repair_sign("x"), x=-50.0) == 50.0


@pytest.mark.parametrize(
    "seconds, text",
    [
        (0, "00:00:00"),
        (3661, "01:01:01"),
        (360000, "100:00:00"),
        (-3663, "-1:-1:-3"),
        (-59, "00:00:-59"),
        (None, "null:null:null"),
    ],
)
def test_duration_text(spark, seconds, text):
    assert value(spark, duration_hms(F.col("s").cast("long")), s=seconds) == text


def test_duration_does_not_depend_on_the_zone(spark):
    """Clocks in New York went from 02:00 to 03:00 that night."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = spark.sql(
            "SELECT TIMESTAMP_NTZ'2024-03-10 01:30:00.9' AS a, TIMESTAMP_NTZ'2024-03-10 03:30:01.1' AS b, "
            "TIMESTAMP_LTZ'2024-03-10 01:30:00.9' AS c, TIMESTAMP_LTZ'2024-03-10 03:30:01.1' AS d, "
            "TIMESTAMP_NTZ'1969-12-31 23:59:59.5' AS e"
        )
        found = times.select(duration_secs("a", "b"), duration_secs("c", "d"), duration_secs("e", "a"))
        assert tuple(found.first()) == (7201, 3601, 1710034201)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_duration_floors_each_side_to_its_second(spark):
    stamp = F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
    fields = {"a": "2024-03-10 01:30:00.9", "b": "2024-03-10 03:30:01.1"}
    assert value(spark, duration_secs(*stamp), **fields) == 7201


def test_surrogate_key_skips_nulls_unless_told_otherwise(spark):
    missing = F.col("n").cast("string")
    same = surrogate_key("a", missing, "b") == surrogate_key("a", "b")
    apart = surrogate_key("a", missing, "b", null_as="") == surrogate_key("a", "b", null_as="")
    assert value(spark, same, a="x", b="y", n=None) is True
    assert value(spark, apart, a="x", b="y", n=None) is False


def test_partition_columns(spark):
    stamp = F.lit("2025-01-31 23:59:59").cast("timestamp_ntz")
    parts = F.struct(year_number(stamp), month_number(stamp), month_text(stamp))
    assert tuple(value(spark, parts)) == (2025, 1, "01")


def test_any_null_quotes_names_and_is_never_null(spark):
    df = spark.sql("SELECT 1 AS `odd name`, CAST(NULL AS INT) AS b")
    assert df.select(any_null(["odd name"]), any_null(["odd name", "b"])).first()[:] == (False, True)
