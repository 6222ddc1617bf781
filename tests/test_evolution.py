"""Schemas that change between the parts of a dataset."""

import datetime as dt
from decimal import Decimal
from itertools import permutations

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from test_trips import drop, trip
from weirflow.plans import trips
from weirflow.sources import IncompatibleSchema, SchemaRecord, read_evolved, read_months
from weirflow.sources.evolution import merge_schemas, widen

ddl = T.StructType.fromDDL

WIDENED = [
    ("tinyint", "int", "int", (3, 70_000)),
    ("smallint", "bigint", "bigint", (3, 1 << 40)),
    ("int", "bigint", "bigint", (-(1 << 31), 1 << 40)),
    ("int", "double", "double", ((1 << 31) - 1, 0.5)),
    ("tinyint", "float", "double", (7, 0.5)),
    ("float", "double", "double", (0.25, 0.1)),
    ("date", "timestamp_ntz", "timestamp_ntz", (dt.date(2026, 1, 2), dt.datetime(2026, 1, 2, 3, 4))),
    ("decimal(5,2)", "decimal(6,4)", "decimal(7,4)", (Decimal("999.99"), Decimal("99.9999"))),
    ("int", "decimal(5,2)", "decimal(12,2)", ((1 << 31) - 1, Decimal("1.25"))),
    ("bigint", "decimal(5,2)", "decimal(22,2)", ((1 << 63) - 1, Decimal("1.25"))),
    ("array<int>", "array<bigint>", "array<bigint>", ([1, None], [1 << 40])),
    ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>", ((1,), (2, "x"))),
]


def plain(value):
    """A struct by its values that are there."""
    return [v for v in value if v is not None] if isinstance(value, T.Row) else value


@pytest.mark.parametrize("one, other, both, values", WIDENED)
def test_files_of_both_types_are_read_without_loss(spark, tmp_path, one, other, both, values):
    types = [ddl(f"v {name}")["v"].dataType for name in (one, other, both)]
    assert widen(types[0], types[1]) == widen(types[1], types[0]) == types[2]
    path = str(tmp_path / "t")
    for name, value in zip((one, other), values):
        spark.createDataFrame([(value,), (None,)], f"v {name}").write.mode("append").parquet(path)
    got = read_evolved(spark, path, ddl(f"v {both}")).where("v IS NOT NULL").collect()
    wanted = [spark.createDataFrame([(value,)], f"v {name}") for name, value in zip((one, other), values)]
    if not isinstance(types[2], T.StructType):
        wanted = [df.select(F.col("v").cast(types[2])) for df in wanted]
    assert sorted(str(plain(row.v)) for row in got) == sorted(str(plain(df.first().v)) for df in wanted)


@pytest.mark.parametrize(
    "one, other",
    [
        ("bigint", "double"),
        ("int", "string"),
        ("date", "timestamp"),
        ("decimal(38,0)", "decimal(38,10)"),
        ("decimal(5,2)", "double"),
        ("array<int>", "int"),
        ("struct<a:int>", "struct<a:string>"),
    ],
)
def test_types_without_a_common_one_are_refused(one, other):
    with pytest.raises(IncompatibleSchema, match="v"):
        merge_schemas(ddl(f"v {one}"), ddl(f"v {other}"))


def test_the_merged_types_do_not_depend_on_the_order():
    parts = [ddl("a int, b float"), ddl("B double, c array<int>"), ddl("a bigint, c array<tinyint>, d date")]
    found = set()
    for some in permutations(parts):
        merged = T.StructType()
        for part in some:
            merged = merge_schemas(merged, part)
        found.add(tuple(sorted((f.name.lower(), f.dataType.simpleString()) for f in merged)))
    assert found == {(("a", "bigint"), ("b", "double"), ("c", "array<int>"), ("d", "date"))}


def test_a_record_never_narrows_and_keeps_nothing_of_a_refused_part(spark, tmp_path):
    record = SchemaRecord(spark, str(tmp_path / "r"))
    with pytest.raises(ValueError):
        record.schema()
    record.add({"m1": ddl("a int"), "m2": ddl("a bigint, b string")})
    assert record.schema() == ddl("a bigint, b string")
    record.add({"m2": ddl("a int")})
    assert record.schema() == ddl("a bigint, b string") and record.parts()["m2"] == ddl("a int")
    with pytest.raises(IncompatibleSchema):
        record.add({"m3": ddl("c int"), "m4": ddl("a string")})
    assert set(record.parts()) == {"m1", "m2"} and record.schema() == ddl("a bigint, b string")


def load(spark, root, month):
    trips.load_trips_bronze(spark, root, f"{month}-01", f"{month}-01", "2026-01-27", evolve=True)


def test_a_month_that_does_not_merge_replaces_nothing(spark, tmp_path):
    root = str(tmp_path)
    drop(root, "2025-10", [trip("2025-10-03 08:00")])
    load(spark, root, "2025-10")
    drop(root, "2025-11", [trip("2025-11-03 08:00")], VendorID="str")
    drop(root, "2025-10", [trip("2025-10-04 08:00", amount=5.0)], PULocationID="str")
    for month in ("2025-11", "2025-10"):
        with pytest.raises(IncompatibleSchema):
            load(spark, root, month)
    got = trips.read_trips_bronze(spark, root).select("month", "total_amount").collect()
    assert list(map(tuple, got)) == [(10, 10.0)]


def test_older_months_show_later_columns_as_null(spark, tmp_path):
    root = str(tmp_path)
    drop(root, "2025-10", [trip("2025-10-03 08:00")], VendorID="int32")
    load(spark, root, "2025-10")
    drop(root, "2025-11", [{**trip("2025-11-03 08:00", vendor=1 << 40), "fee": 1.5}])
    load(spark, root, "2025-11")
    # The older month comes again, still narrow, after the wider one.
    drop(root, "2025-10", [trip("2025-10-05 08:00", vendor=2)], VendorID="int32")
    load(spark, root, "2025-10")
    df = trips.read_trips_bronze(spark, root)
    assert sorted(map(tuple, df.select("month", "VendorID", "fee").collect())) == [(10, 2, None), (11, 1 << 40, 1.5)]
    # A bound beyond the older files' type still reaches the scan and is right.
    wide = df.where(F.col("VendorID") > (1 << 33))
    assert "GreaterThan(VendorID,8589934592)" in wide._jdf.queryExecution().toString()
    assert wide.count() == 1


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_a_decade_of_months_is_one_scan(spark, tmp_path):
    months = [f"{2010 + i // 12}-{i % 12 + 1:02d}" for i in range(120)]
    for i, month in enumerate(months):
        drop(str(tmp_path), month, [trip(f"{month}-02 08:00", amount=float(i))])
    df = read_months(spark, f"{tmp_path}/{trips.DROP}", months)
    split = trips.split_months(df, months)
    assert scans(split.inside) == scans(split.outside) == 1
    got = df.select("source_month", "total_amount").collect()
    assert sorted(map(tuple, got)) == [(month, float(i)) for i, month in enumerate(months)]
    assert split.inside.count() == 120 and split.outside.count() == 0


def test_strays_between_two_drops_are_found_in_both_directions(spark, tmp_path):
    root = str(tmp_path)
    late, early = trip("2025-12-01 00:00", amount=1.0), trip("2025-10-31 23:59", amount=2.0)
    drop(root, "2025-11", [late, early, {**trip("2025-11-05 08:00"), "tpep_pickup_datetime": pd.NaT}])
    drop(root, "2025-12", [trip("2025-11-30 10:00", amount=3.0), trip("2025-12-05 10:00")])
    months = ["2025-11", "2025-12"]
    df = read_months(spark, f"{root}/{trips.DROP}", months)
    split = trips.split_months(df, months)
    assert sorted(r.total_amount for r in split.outside.collect()) == [1.0, 2.0, 3.0, 10.0]
    assert split.inside.count() == 1


def test_odd_characters_in_a_layout(spark, tmp_path):
    layout = f"{tmp_path}/a b%/drop ({{month}})+"
    spark.range(3).write.parquet(layout.format(month="2025-10"))
    spark.range(2).write.parquet(layout.format(month="2025-11"))
    df = read_months(spark, layout, ["2025-10", "2025-11"])
    assert sorted(map(tuple, df.groupBy("source_month").count().collect())) == [("2025-10", 3), ("2025-11", 2)]
