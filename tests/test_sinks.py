import datetime as dt

import pytest
from pyspark.sql import DataFrameWriter

from weirflow.operators import stamp_date
from weirflow.sinks import (
    preview,
    replace_partitions,
    write_jdbc,
    write_partitions,
    write_rejects,
    write_snapshot,
    write_table,
)
from weirflow.sources import read_dataset


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "part string, v int")


def content(spark, path):
    return sorted((r["part"], r["v"]) for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("rebalance", [False, True])
def test_dynamic_overwrite_replaces_only_partitions_it_has(spark, tmp_path, rebalance):
    path = str(tmp_path / "t")
    write_partitions(rows(spark, ("a", 1), ("b", 2)), path, ["part"], rebalance=rebalance)
    write_partitions(rows(spark, ("b", 3), ("c", 4)), path, ["part"], rebalance=rebalance)
    assert content(spark, path) == [("a", 1), ("b", 3), ("c", 4)]


def test_snapshot_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(rows(spark, ("a", 1), ("b", 2)), path, ["part"])
    write_snapshot(rows(spark, ("b", 3)), path, ["part"])
    assert content(spark, path) == [("b", 3)]


def test_sinks_ignore_the_session_overwrite_mode(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_snapshot(rows(spark, ("a", 1)), path, ["part"])
        write_snapshot(rows(spark, ("b", 3)), path, ["part"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert content(spark, path) == [("b", 3)]


def test_owned_partitions_without_rows_are_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(rows(spark, ("a", 1), ("b", 2), ("c", 3)), path, ["part"])
    replace_partitions(rows(spark, ("a", 9)), path, [{"part": "a"}, {"part": "b"}])
    assert content(spark, path) == [("a", 9), ("c", 3)]
    replace_partitions(rows(spark).where("1 = 0"), path, [{"part": "a"}])
    assert content(spark, path) == [("c", 3)]


def test_a_row_of_another_partition_stops_the_write(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(rows(spark, ("a", 1), ("b", 2), ("b", 3)), path, ["part"])
    for foreign in (("b", 9), (None, 9)):
        with pytest.raises(Exception, match="no partition of this load"):
            replace_partitions(rows(spark, ("a", 7), foreign), path, [{"part": "a"}])
    assert content(spark, path) == [("a", 1), ("b", 2), ("b", 3)]


def test_first_load_without_rows_gives_a_readable_dataset(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_partitions(rows(spark), path, [{"part": "a"}])
    assert content(spark, path) == []


def test_reject_csv_has_a_header_and_a_date_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    date = dt.date(2026, 1, 27)
    df = stamp_date(rows(spark, ("a", 1), (None, 2)), date)
    write_rejects(df, path, date)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["part", "v", "processing_date"]
    assert sorted((r["part"] or "", r["v"], str(r["processing_date"])) for r in back.collect()) == [
        ("", "2", "2026-01-27"),
        ("a", "1", "2026-01-27"),
    ]
    write_rejects(df.where("v > 5"), path, date)
    assert spark.read.option("header", True).csv(path).count() == 0


def test_unpartitioned_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(rows(spark, ("a", 1), ("b", 1)), path)
    write_table(rows(spark, ("c", 2)), path)
    assert content(spark, path) == [("c", 2)]


def test_dates_prune_partitions(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    for day in ("2026-01-27", "2026-01-28"):
        write_partitions(stamp_date(rows(spark, (day, 1)), day), path, ["processing_date"])
    df = read_dataset(spark, path, dates=["2026-01-28"])
    assert [r["part"] for r in df.collect()] == ["2026-01-28"]
    df.explain(mode="formatted")
    assert "PartitionFilters: [" in capsys.readouterr().out.replace("PartitionFilters: []", "")


def test_preview_prints_twenty_rows(spark, capsys):
    preview(spark.range(50))
    assert "only showing top 20 rows" in capsys.readouterr().out


def test_jdbc_settings(spark, monkeypatch):
    """What reaches Spark's writer; no database is involved."""
    calls = []
    monkeypatch.setattr(
        DataFrameWriter,
        "jdbc",
        lambda self, url, table, mode=None, properties=None: calls.append((url, table, mode, properties)),
    )
    df = rows(spark, ("a", 1))
    write_jdbc(df, "jdbc:x", "t", {"user": "u", "driver": "d"})
    write_jdbc(df, "jdbc:x", "t", {"batchsize": "5"}, connections=8)
    assert calls == [
        ("jdbc:x", "t", "overwrite", {"batchsize": "10000", "numPartitions": "16", "user": "u", "driver": "d"}),
        ("jdbc:x", "t", "overwrite", {"batchsize": "5", "numPartitions": "8"}),
    ]
