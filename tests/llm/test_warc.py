import gzip
import os

import pytest
from pyspark.sql import functions as F

from weirflow.llm import warc

SCHEMA = "page_id long, url string, html string, file string, record int, start int"


def pages_of(spark, n=200):
    rows = [(i, f"http://x/{i}", f"<p>é page {i}</p>\r\n\r\n" * (i % 7), "f", 1, 2) for i in range(n)]
    rows += [(None, None, None, None, None, None), (5, "http://a\r\nb", "same", "f", 1, 2)] + [(6, "u", "", "f", 1, 2)] * 2
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def normal(rows):
    quoted = [(r.page_id, None if r.url is None else r.url.replace("\r\n", "%0D%0A"), r.html) for r in rows]
    return sorted(quoted, key=str)


def test_round_trip_and_drill(spark, tmp_path):
    pages, path = pages_of(spark), str(tmp_path)
    index = warc.write_replicas(pages, path, damage=F.col("page_id") % 10 == 3, file_bytes=3_000)
    assert index.select("file").distinct().count() > 5
    damaged = warc.audit(index, path)
    found = damaged.join(index, ["file", "record"]).collect()
    assert sorted(r.page_id for r in found) == [i for i in range(200) if i % 10 == 3]
    assert all(r.damaged_replicas == [1] for r in found)
    records = warc.read_records(index, path, damaged).collect()
    assert normal(records) == normal(pages.collect())


def test_files_are_valid_archives(spark, tmp_path):
    index = warc.write_replicas(pages_of(spark, 20), str(tmp_path), file_bytes=1 << 20)
    for name in {r.file for r in index.collect()}:
        content = gzip.open(tmp_path / "replica-0" / name).read()
        assert content.startswith(b"WARC/1.1\r\n")
        assert content.endswith(b"\r\n\r\n")


def test_clean_replicas_and_no_pages(spark, tmp_path):
    index = warc.write_replicas(pages_of(spark), str(tmp_path / "a"))
    assert warc.audit(index, str(tmp_path / "a")).collect() == []
    none = warc.write_replicas(pages_of(spark).where("false"), str(tmp_path / "b"))
    damaged = warc.audit(none, str(tmp_path / "b"))
    assert damaged.collect() == []
    assert warc.read_records(none, str(tmp_path / "b"), damaged).collect() == []


def test_missing_and_truncated_files(spark, tmp_path):
    path = str(tmp_path)
    index = warc.write_replicas(pages_of(spark), path, replicas=3, file_bytes=3_000)
    files = sorted({r.file for r in index.collect()})
    os.remove(tmp_path / "replica-0" / files[0])
    cut = tmp_path / "replica-2" / files[1]
    cut.write_bytes(cut.read_bytes()[:-1])
    damaged = {(r.file, r.record): r.damaged_replicas for r in warc.audit(index, path, 3).collect()}
    rows = index.collect()
    last = max(r.record for r in rows if r.file == files[1])
    expected = {(r.file, r.record): [0] for r in rows if r.file == files[0]} | {(files[1], last): [2]}
    assert damaged == expected


def test_damage_that_all_replicas_share_is_found(spark, tmp_path):
    index = warc.write_replicas(pages_of(spark, 10), str(tmp_path), file_bytes=1 << 20)
    row = index.orderBy("file", "record").first()
    for replica in ("replica-0", "replica-1"):
        file = tmp_path / replica / row.file
        data = bytearray(file.read_bytes())
        data[row.start + row.length // 2] ^= 1
        file.write_bytes(bytes(data))
    damaged = warc.audit(index, str(tmp_path))
    assert [tuple(r) for r in damaged.collect()] == [(row.file, row.record, [0, 1])]
    lost = warc.read_records(index, str(tmp_path), damaged).where("html IS NULL AND file = '%s' AND record = %d" % (row.file, row.record))
    assert lost.count() == 1


@pytest.mark.parametrize("n", [1, 2, 16, 17, 300])
def test_trees(n):
    leaves = [bytes([i % 256, i // 256]) for i in range(n)]
    levels = warc.tree_levels(leaves)
    assert len(levels[0]) == 1 and len(levels[-1]) == n
    for i in {0, n // 2, n - 1}:
        other = warc.tree_levels([*leaves[:i], b"changed", *leaves[i + 1 :]])
        for depth, (a, b) in enumerate(zip(levels, other, strict=True)):
            below = 16 ** (len(levels) - 1 - depth)
            assert [p for p in range(len(a)) if a[p] != b[p]] == [i // below]


def test_a_damaged_block_is_not_parsed():
    member = warc.record_bytes(1, "u", "text")
    assert warc.parse_record(member) == (1, "u", "text")
    with pytest.raises(Exception):  # noqa: B017 - the packing or the digest
        warc.parse_record(warc._flipped(member))


@pytest.mark.parametrize("scheme", ["s3", "s3a", "s3n"])
def test_schemes_of_spark_reach_the_same_store(monkeypatch, scheme):
    asked = []

    class Stores:
        class FileSystem:
            from_uri = staticmethod(lambda uri: (asked.append(uri), ("store", "path"))[1])

    monkeypatch.setattr(warc, "fs", Stores)
    assert warc._store(f"{scheme}://bucket/a b/c") == ("store", "path")
    warc._store("hdfs://host/a")
    warc._store("/local/a")
    assert asked == ["s3://bucket/a b/c", "hdfs://host/a", "/local/a"]
