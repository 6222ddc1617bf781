import datetime as dt

import pytest
from pyspark.sql import functions as F

from weirflow.streaming import Compaction, await_all, stream_parquet, stream_to_parquet

DAYS = [dt.date(2025, 3, day) for day in (1, 2, 3)]


class Lake:
    """A stream that appends a few rows for some days in each of its batches."""

    def __init__(self, spark, root):
        self.spark, self.root, self.rows = spark, str(root), []
        self.compaction = Compaction(spark, f"{self.root}/out", f"{self.root}/compacted")

    def batch(self, days, n=20):
        new = [(len(self.rows) + i, f"row {i}", days[i % len(days)]) for i in range(n)]
        self.rows += new
        df = self.spark.createDataFrame(new, "id long, note string, processing_date date")
        df.repartition(2).write.mode("append").parquet(f"{self.root}/in")
        await_all(self.stream("in", "out"))

    def stream(self, source, target):
        schema = self.spark.read.parquet(f"{self.root}/in").schema
        df = stream_parquet(self.spark, f"{self.root}/{source}", schema)
        return stream_to_parquet(df, f"{self.root}/{target}", f"{self.root}/checkpoint-{target}", every=None)

    def read(self):
        return sorted(tuple(r) for r in self.compaction.read().select("id", "note", "processing_date").collect())

    def files(self, day):
        """Files that hold the day's rows, as a reader finds them."""
        rows = self.compaction.read().where(F.col("processing_date") == day)
        return rows.select(F.input_file_name()).distinct().collect()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_closed_dates_become_few_files_with_the_same_rows(lake):
    for _ in range(4):
        lake.batch(DAYS)
    before = [len(lake.files(day)) for day in DAYS]
    assert min(before) >= 4 and lake.read() == sorted(lake.rows)
    assert lake.compaction.compact(DAYS[2]) == ["2025-03-01", "2025-03-02"]
    assert [len(lake.files(day)) for day in DAYS] == [1, 1, before[2]]
    assert lake.read() == sorted(lake.rows)
    assert lake.compaction.read().columns == ["id", "note", "processing_date"]
    assert lake.compaction.compact(DAYS[2]) == []


def test_a_file_that_comes_later_is_not_lost(lake):
    lake.batch(DAYS[:2])
    lake.compaction.compact(DAYS[2])
    lake.batch(DAYS[1:])
    assert lake.read() == sorted(lake.rows)
    assert len(lake.files(DAYS[0])) == 1 and len(lake.files(DAYS[1])) > 1
    assert lake.compaction.compact(DAYS[2]) == ["2025-03-02"]
    assert len(lake.files(DAYS[1])) == 1 and lake.read() == sorted(lake.rows)


def test_a_tailing_stream_sees_every_row_once(lake):
    lake.batch(DAYS)
    await_all(lake.stream("out", "tail"))
    lake.batch(DAYS)
    lake.compaction.compact(DAYS[2])
    lake.batch(DAYS)
    await_all(lake.stream("out", "tail"))
    tail = lake.spark.read.parquet(f"{lake.root}/tail")
    assert sorted(r.id for r in tail.collect()) == [row[0] for row in lake.rows]


def test_filters_and_columns_reach_both_scans(lake):
    lake.batch(DAYS)
    lake.compaction.compact(DAYS[2])
    found = lake.compaction.read().where((F.col("processing_date") == DAYS[0]) & (F.col("id") > 5)).select("id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(id), GreaterThan(id,5)]") >= 1
    assert "note" not in plan
    assert sorted(r.id for r in found.collect()) == [r[0] for r in lake.rows if r[2] == DAYS[0] and r[0] > 5]


def test_a_reader_goes_on_while_old_files_are_removed(lake):
    lake.batch(DAYS[:1])
    lake.compaction.compact(DAYS[2])
    reader = lake.compaction.read()
    lake.batch(DAYS[:1])
    lake.compaction.compact(DAYS[2])
    lake.compaction.vacuum(keep=2)
    assert reader.count() == 20
    lake.compaction.vacuum(keep=1)
    assert lake.read() == sorted(lake.rows)
    assert len(lake.compaction._log.versions()) == 1


def test_one_of_two_compactions_at_once_fails(lake, monkeypatch):
    lake.batch(DAYS)
    other = Compaction(lake.spark, lake.compaction.path, lake.compaction.target)
    commit = lake.compaction._log.commit

    def late(version, state):
        other.compact(DAYS[2])
        commit(version, state)

    monkeypatch.setattr(lake.compaction._log, "commit", late)
    with pytest.raises(RuntimeError, match="another"):
        lake.compaction.compact(DAYS[2])
    assert lake.read() == sorted(lake.rows)


def test_several_partition_columns(spark, tmp_path):
    rows = [(i, i % 2 == 0, DAYS[i % 3]) for i in range(30)]
    schema = "id long, is_valid boolean, processing_date date"
    for _ in range(2):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stream_parquet(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
        by = ["processing_date", "is_valid"]
        await_all(stream_to_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", by=by, every=None))
    compaction = Compaction(spark, f"{tmp_path}/out", f"{tmp_path}/compacted", by=by)
    assert len(compaction.compact(DAYS[2])) == 2
    found = compaction.read().select("id", F.col("is_valid").cast("boolean"), "processing_date")
    assert sorted(map(tuple, found.collect())) == sorted(rows * 2)


def test_rows_without_a_date_stay_in_the_sink(lake):
    lake.batch([None, DAYS[0]])
    assert lake.compaction.compact(DAYS[2]) == ["2025-03-01"]
    found = lake.compaction.read().select("id", "note", "processing_date").collect()
    assert sorted(map(tuple, found)) == sorted(lake.rows)


def test_nothing_to_compact(lake):
    lake.batch(DAYS)
    assert lake.compaction.compact(DAYS[0]) == []
    assert lake.read() == sorted(lake.rows)
