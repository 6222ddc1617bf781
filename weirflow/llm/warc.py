"""WARC files with replicas, and their fixity audit by Merkle trees.

``write_replicas`` writes pages as WARC files, each record a gzip member of its
own, with an index of the records' offset ranges and digests. ``audit`` hashes
the ranges of every replica and folds them, in the order of their offsets, into
one tree per file. It compares the roots of the replicas (and of the digests
recorded in the index) and descends only below nodes that differ, down to the
damaged records. ``read_records`` reads records back, each from a replica where
it is intact.

Files are written and read in tasks; one task holds one record, and the hashes
of one file. A file counts only if the index names it, so what a lost task has
written is never read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import staged

# A file that has reached this size is followed by the next one.
FILE_BYTES = 256 << 20
FAN_OUT = 16
RECORDED = -1  # the digests in the index, as if they were a replica's

_INDEX = "file string, record long, start long, length long, page_id long, digest binary"
_NODES = "replica int, file string, depth int, pos long, leaf boolean, hash binary"


def record_bytes(page_id: int | None, url: str | None, html: str | None) -> bytes:
    """One WARC record as a gzip member. Nulls have no header line; line breaks
    in a URL are percent-encoded."""
    block = (html or "").encode()
    fields = [
        ("WARC-Type", "resource"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "text/html; charset=utf-8"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if html is None:
        fields.append(("X-Null-Block", "true"))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + block + b"\r\n\r\n") + pack.flush()


def parse_record(member: bytes) -> tuple[int | None, str | None, str | None]:
    """page_id, url and html of a record; raises if its block is damaged."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError("the block does not have its digest")
    page_id = fields.get("X-Page-ID")
    html = None if "X-Null-Block" in fields else block.decode()
    return (None if page_id is None else int(page_id)), fields.get("WARC-Target-URI"), html


def _replica(path: str, number: int) -> str:
    return f"{path}/replica-{number}"


def write_replicas(
    pages: DataFrame,
    path: str,
    replicas: int = 2,
    damage: Column | None = None,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write every row of ``pages`` (page_id, url, html) to the same files of each
    replica below ``path``; returns the index, staged.

    Null ids, URLs and pages are kept as such, repeated rows are records of
    their own, an empty table gives no files, other columns are ignored.
    ``damage`` is for drills: where it holds, one byte of the record is flipped
    in the last replica after the digest was taken.
    """
    flag = F.lit(False) if damage is None else F.coalesce(damage, F.lit(False))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, record, start, number = "", [], 0, 0, 0
        task = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if not out or start >= file_bytes:
                        for stream in out:
                            stream.close()
                        name, record, start = f"pages-{task}-{number:04d}.warc.gz", 0, 0
                        number += 1
                        out = [_create(f"{_replica(path, r)}/{name}") for r in range(replicas)]
                    member = record_bytes(row["page_id"], row["url"], row["html"])
                    for stream in out[:-1]:
                        stream.write(member)
                    out[-1].write(_flipped(member) if row["damage"] else member)
                    digest = hashlib.sha256(member).digest()
                    rows.append((name, record, start, len(member), row["page_id"], digest))
                    record, start = record + 1, start + len(member)
                if rows:
                    yield _batch(rows, _index_schema())
        finally:
            for stream in out:
                stream.close()

    wanted = pages.select("page_id", "url", "html", flag.alias("damage"))
    return staged(wanted.mapInArrow(write, _INDEX), "warc-index")


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """Spark's names of the S3 scheme are those of Hadoop's connectors."""
    scheme, colon, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"s3://{rest}" if colon and scheme in ("s3a", "s3n") else uri)


def _create(uri: str):
    store, path = _store(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)  # members are packed already


def _flipped(member: bytes) -> bytes:
    middle = len(member) // 2
    return member[:middle] + bytes([member[middle] ^ 1]) + member[middle + 1 :]


def _index_schema() -> pa.Schema:
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.schema(list(zip("file record start length page_id digest".split(), types, strict=True)))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), schema.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


class _Ranges:
    """Reads ranges of a replica's files, one open file at a time."""

    def __init__(self, folder: str) -> None:
        self._folder, self._name, self._file = folder, None, None

    def read(self, name: str, start: int, length: int) -> bytes | None:
        """None if the file or a part of the range is missing."""
        if name != self._name:
            self.close()
            self._name = name
            store, path = _store(f"{self._folder}/{name}")
            try:
                self._file = store.open_input_file(path)
            except FileNotFoundError:
                self._file = None
        if self._file is None or self._file.size() < start + length:
            return None
        return self._file.read_at(length, start)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


def tree_levels(leaves: list[bytes]) -> list[list[bytes]]:
    """The levels of a tree from the root down to the leaves. A node is the hash
    of up to FAN_OUT children; leaves and nodes are hashed with different
    prefixes, so that one cannot stand for the other."""
    level = [hashlib.sha256(b"\0" + leaf).digest() for leaf in leaves]
    levels = [level]
    while len(level) > 1:
        level = [
            hashlib.sha256(b"\1" + b"".join(level[i : i + FAN_OUT])).digest()
            for i in range(0, len(level), FAN_OUT)
        ]
        levels.append(level)
    return levels[::-1]


def _by_file(index: DataFrame) -> DataFrame:
    """Whole files in each task, ranges in order. Files have a bounded size."""
    return index.repartition("file").sortWithinPartitions("file", "start")


def merkle_nodes(index: DataFrame, path: str, replicas: int = 2) -> DataFrame:
    """The trees of all files in all replicas, and of the recorded digests."""

    def hash_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores = [_Ranges(_replica(path, r)) for r in range(replicas)]
        name, leaves = None, {}

        def nodes():
            for replica, found in leaves.items():
                levels = tree_levels(found)
                for depth, level in enumerate(levels):
                    leaf = depth == len(levels) - 1
                    yield _batch(
                        [(replica, name, depth, pos, leaf, node) for pos, node in enumerate(level)],
                        schema,
                    )

        kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
        schema = pa.schema(list(zip("replica file depth pos leaf hash".split(), kinds, strict=True)))
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if row["file"] != name:
                        yield from nodes()
                        name, leaves = row["file"], {r: [] for r in (RECORDED, *range(replicas))}
                    leaves[RECORDED].append(row["digest"])
                    for replica, store in enumerate(stores):
                        member = store.read(name, row["start"], row["length"])
                        leaves[replica].append(
                            b"missing" if member is None else hashlib.sha256(member).digest()
                        )
            yield from nodes()
        finally:
            for store in stores:
                store.close()

    wanted = index.select("file", "start", "length", "digest")
    return staged(_by_file(wanted).mapInArrow(hash_files, _NODES), "warc-nodes")


def audit(index: DataFrame, path: str, replicas: int = 2) -> DataFrame:
    """The damaged records: file, record and damaged_replicas (their numbers in
    ascending order). Files that are missing are damaged in all their records.

    An empty index gives no rows. Only children of differing nodes are looked
    at, level by level; there are as many levels as the largest file needs.
    """
    nodes = merkle_nodes(index, path, replicas)
    deepest = nodes.agg(F.max("depth")).first()[0]
    damaged, differing = None, None
    for depth in range((-1 if deepest is None else deepest) + 1):
        level = nodes.where(F.col("depth") == depth)
        if differing is not None:
            parents = differing.where("NOT leaf").select("file", F.col("pos").alias("parent"))
            level = level.withColumn("parent", F.expr(f"pos DIV {FAN_OUT}")).join(
                parents, ["file", "parent"], "left_semi"
            )
        # As many rows of a node as there are replicas.
        compared = level.groupBy("file", "pos", "leaf").agg(
            F.map_from_entries(F.collect_list(F.struct("replica", "hash"))).alias("hashes")
        )
        same = F.forall(F.map_values("hashes"), lambda h: h == F.col("hashes")[F.lit(RECORDED)])
        differing = staged(compared.where(~same), "warc-differing")
        found = differing.where("leaf")
        damaged = found if damaged is None else damaged.unionByName(found)
        if differing.where("NOT leaf").isEmpty():
            break
    if damaged is None:
        damaged = nodes.select("file", "pos", F.map_from_arrays(F.array("replica"), F.array("hash")).alias("hashes"))
    others = F.filter(
        F.map_keys("hashes"), lambda r: F.col("hashes")[r] != F.col("hashes")[F.lit(RECORDED)]
    )
    return damaged.select(
        "file", F.col("pos").alias("record"), F.array_sort(others).alias("damaged_replicas")
    )


def read_records(index: DataFrame, path: str, damaged: DataFrame, replicas: int = 2) -> DataFrame:
    """page_id, url, html, file, record, damaged_replicas (empty if none) of every
    record, read from the first replica where it is intact.

    A record that is damaged everywhere has null url and html.
    """
    schema = (
        "page_id long, url string, html string, file string, record long, damaged_replicas array<int>"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores = [_Ranges(_replica(path, r)) for r in range(replicas)]
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    bad = row["damaged_replicas"]
                    good = next((r for r in range(replicas) if r not in bad), None)
                    url = html = None
                    if good is not None:
                        member = stores[good].read(row["file"], row["start"], row["length"])
                        _, url, html = parse_record(member)
                    rows.append((row["page_id"], url, html, row["file"], row["record"], bad))
                if rows:
                    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32())]
                    names = "page_id url html file record damaged_replicas".split()
                    yield _batch(rows, pa.schema(list(zip(names, kinds, strict=True))))
        finally:
            for store in stores:
                store.close()

    none = F.array().cast("array<int>")
    marked = index.join(damaged, ["file", "record"], "left").withColumn(
        "damaged_replicas", F.coalesce("damaged_replicas", none)
    )
    return _by_file(marked.drop("digest")).mapInArrow(read, schema)
