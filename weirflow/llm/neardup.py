"""Near-duplicate documents by fast similarity sketches, banding and exact checks.

1. Every text gets its set of word shingles, and a sketch of it. Texts with
   equal sets are one class; its smallest id stands for it from here on.
2. Classes that share a band of their sketches meet in a bucket. Those whose
   sketches agree well enough become candidates; a bucket gives at most as many
   candidate pairs as it has members, enough to connect them.
3. The components of the candidates are small sets of documents that can have
   links. Their full sets travel once, and all links that still connect
   something are confirmed on them.
4. The components of the links are the groups of near-duplicates.

Buckets and candidate components of any size are cut into chunks, and pairs of
chunks are separate groups of rows, so no task holds more than two chunks. No
pair is left out: a group of n members costs n * n comparisons at worst, but
never as many rows.

Two sets of similarity 0.75 share none of the 32 bands of 4 coordinates with a
probability of 5 in a million, and their sketches differ from the similarity by
0.19 (five standard errors) less often than that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.llm.common import staged
from weirflow.llm.components import connected_components
from weirflow.llm.shingles import COORDINATES, Hasher, bands, mixed, short, sketch
from weirflow.llm.tokens import text_steps

# Links: 100 * intersection >= LINK * union.
LINK = 75
# Sketches that agree in so many of their coordinates are candidates.
AGREE = int(COORDINATES * (LINK / 100 - 0.19))
BUCKET_ROWS = 4096
CHUNK_ROWS, CHUNK_SHINGLES = 2048, 2_000_000

_FEATURES = "n_shingles long, key_a long, key_b long, bands array<long>, sketch binary"


def features(docs: DataFrame) -> DataFrame:
    """doc_id, the size of its set, a 128-bit key of the set, bands and sketch;
    the last three are null for an empty set."""
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(_FEATURES).fields])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            start = 0
            for size in text_steps(batch.column("text")):
                part = batch.slice(start, size)
                start += size
                rows = []
                for hashes in hasher.sets(part.column("text")):
                    if not len(hashes):
                        rows.append((0, None, None, None, None))
                        continue
                    key_a, key_b = (
                        int(mixed(hashes ^ np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64))
                        for salt in (1, 2)
                    )
                    values = sketch(hashes)
                    rows.append((len(hashes), key_a, key_b, bands(values), short(values)))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], schema.names)

    return staged(docs.select("doc_id", "text").mapInArrow(describe, schema), "dedup-features")


def _whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, with the first row of each (and the number of
    rows at the end), from rows sorted by ``keys`` (all long)."""
    held: list[pa.RecordBatch] = []
    last = None

    def cut(table: pa.Table) -> np.ndarray:
        columns = np.stack([table.column(k).to_numpy() for k in keys])
        return np.flatnonzero((np.diff(columns, axis=1) != 0).any(axis=0)) + 1

    for batch in batches:
        if not batch.num_rows:
            continue
        ends = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
        if last is not None and last == ends == tuple(batch.column(k)[0].as_py() for k in keys):
            held.append(batch)
            continue
        table = pa.Table.from_batches([*held, batch])
        borders = cut(table)
        if len(borders):
            yield table.slice(0, int(borders[-1])), np.concatenate([[0], borders])
            table = table.slice(int(borders[-1]))
        held, last = table.combine_chunks().to_batches(), ends
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.array([0, table.num_rows])


def _binaries(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, and its offsets."""
    array = column.combine_chunks().cast(pa.large_binary())
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, 8 * array.offset)
    data = np.frombuffer(array.buffers()[2], np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0]))
    return data, offsets - offsets[0]


class _Sets:
    """Which members of a group are connected so far."""

    def __init__(self, n: int) -> None:
        self.labels = np.arange(n)

    def join(self, x: int, y: int) -> bool:
        a, b = self.labels[x], self.labels[y]
        if a == b:
            return False
        self.labels[self.labels == b] = a
        return True


def _agreeing(sketches: np.ndarray, first: int) -> list[tuple[int, int]]:
    """Pairs of agreeing members that connect all that agree. ``first`` is 0 for
    all pairs, or the number of members that only meet the ones after them."""
    n = len(sketches)
    sets, out = _Sets(n), []
    for x in range(first or n):
        others = np.arange(max(first, x + 1), n)
        others = others[sets.labels[others] != sets.labels[x]]
        if not len(others):
            continue
        agree = others[(sketches[others] == sketches[x]).sum(axis=1) >= AGREE]
        out += [(x, y) for y in agree.tolist() if sets.join(x, y)]
    return out


def _chunk_pairs(count: str, keys: list[str], df: DataFrame) -> DataFrame:
    """Deal rows into groups: of one chunk if ``count`` says that one is enough,
    else of every pair of chunks. Adds low and high (the pair), side (0 or 1)."""
    chunk = F.pmod(F.xxhash64("doc_id"), F.col("chunks"))
    mate = F.explode(F.expr("sequence(0L, chunks - 1)"))
    dealt = df.withColumn("chunks", F.expr(count)).withColumn("chunk", chunk).withColumn("mate", mate)
    dealt = (
        dealt.withColumn("low", F.least("chunk", "mate"))
        .withColumn("high", F.greatest("chunk", "mate"))
        .withColumn("side", F.expr("IF(chunk = low, 0, 1)"))
        .drop("chunks", "chunk", "mate")
    )
    order = [*keys, "low", "high"]
    return dealt.repartition(*order).sortWithinPartitions(*order, "side", "doc_id")


def candidate_pairs(representatives: DataFrame) -> DataFrame:
    """a, b: pairs (of doc_id, bands, sketch) that connect all candidates."""
    members = representatives.select(
        "doc_id", F.posexplode("bands").alias("band", "hash")
    ).select("doc_id", F.xxhash64("band", "hash").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    meeting = members.join(shared, "bucket").join(representatives.select("doc_id", "sketch"), "doc_id")
    groups = _chunk_pairs(
        f"CAST(ceil(members / {BUCKET_ROWS}) AS LONG)",
        ["bucket"],
        meeting.select("bucket", "members", "doc_id", "sketch"),
    )

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, borders in _whole_groups(batches, ["bucket", "low", "high"]):
            ids = table.column("doc_id").to_numpy()
            sketches = _binaries(table.column("sketch"))[0].reshape(len(ids), COORDINATES)
            side = table.column("side").to_numpy()
            cross = table.column("low").to_numpy() != table.column("high").to_numpy()
            starts, sizes = borders[:-1], np.diff(borders)
            # Most groups are settled by comparing every member with the first.
            owner = np.repeat(starts, sizes)
            agree = (sketches == sketches[owner]).sum(axis=1) >= AGREE
            settled = np.logical_and.reduceat(agree, starts) & ~cross[starts]
            easy = np.repeat(settled, sizes) & (owner != np.arange(len(ids)))
            a, b = [ids[owner[easy]]], [ids[easy]]
            for start, size in zip(starts[~settled].tolist(), sizes[~settled].tolist(), strict=True):
                first = int((side[start : start + size] == 0).sum()) if cross[start] else 0
                pairs = _agreeing(sketches[start : start + size], first)
                if pairs:
                    at = np.array(pairs) + start
                    a.append(ids[at[:, 0]])
                    b.append(ids[at[:, 1]])
            yield pa.RecordBatch.from_pydict({"a": np.concatenate(a), "b": np.concatenate(b)})

    return groups.mapInArrow(connect, "a long, b long").distinct()


def _linked(ids: np.ndarray, shingles: np.ndarray, offsets: np.ndarray, first: int) -> list[tuple[int, int]]:
    """Links of a group that connect all that is linked in it; ``first`` as for
    ``_agreeing``. ``shingles`` holds the sets one after another."""
    n = len(ids)
    sets, out = _Sets(n), []
    _, dense = np.unique(shingles, return_inverse=True)
    marks = np.zeros(int(dense.max()) + 1 if len(dense) else 0, np.int64)
    sizes = np.diff(offsets)
    starts = offsets[:-1]
    for x in range(first or n):
        others = np.arange(max(first, x + 1), n)
        others = others[sets.labels[others] != sets.labels[x]]
        # Sizes alone rule out many.
        low, high = np.minimum(sizes[others], sizes[x]), np.maximum(sizes[others], sizes[x])
        others = others[100 * low >= LINK * high]
        if not len(others):
            continue
        own = dense[offsets[x] : offsets[x + 1]]
        marks[own] = 1
        if len(others) * 4 > n:
            common = np.add.reduceat(marks[dense], starts)[others]
        else:
            common = np.array([marks[dense[offsets[y] : offsets[y + 1]]].sum() for y in others])
        marks[own] = 0
        union = sizes[x] + sizes[others] - common
        out += [(x, y) for y in others[100 * common >= LINK * union].tolist() if sets.join(x, y)]
    return out


def links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """a, b: links that connect all linked documents. ``members`` gives the
    doc_id and the candidate component of the documents to compare, ``docs``
    their texts (of one row for each id)."""
    texts = docs.join(members, "doc_id").select("component", "doc_id", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            start = 0
            for size in text_steps(batch.column("text")):
                part = batch.slice(start, size)
                start += size
                sets = list(hasher.sets(part.column("text")))
                yield pa.RecordBatch.from_pydict(
                    {
                        "component": part.column("component"),
                        "doc_id": part.column("doc_id"),
                        "n": pa.array(map(len, sets), pa.int64()),
                        "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
                    }
                )

    sets = staged(
        texts.mapInArrow(describe, "component long, doc_id long, n long, shingles binary"), "dedup-sets"
    )
    sizes = sets.groupBy("component").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("all"))
    groups = _chunk_pairs(
        f"CAST(ceil(greatest(members / {CHUNK_ROWS}, all / {CHUNK_SHINGLES})) AS LONG)",
        ["component"],
        sets.join(sizes, "component").select("component", "members", "all", "doc_id", "shingles"),
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, borders in _whole_groups(batches, ["component", "low", "high"]):
            for start, end in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
                group = table.slice(start, end - start)
                ids = group.column("doc_id").to_numpy()
                data, offsets = _binaries(group.column("shingles"))
                cross = group.column("low")[0].as_py() != group.column("high")[0].as_py()
                first = int(pc.sum(pc.equal(group.column("side"), 0)).as_py()) if cross else 0
                if cross and first == len(ids):
                    continue
                found = _linked(ids, np.frombuffer(data.tobytes(), np.uint64), offsets // 8, first)
                if found:
                    at = np.array(found)
                    yield pa.RecordBatch.from_pydict({"a": ids[at[:, 0]], "b": ids[at[:, 1]]})

    return groups.mapInArrow(confirm, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Group every row of ``docs`` (doc_id, text) with its near-duplicates.

    Returns doc_id, n_shingles (size of its set), component_id (the smallest id
    it is linked with over any number of links, itself included) and kept
    (whether that is its own). Sets are of distinct five-word shingles, of the
    whole text where it has fewer words; a text that is null or has no words has
    none and is linked with nothing.

    Ids are taken as unique: rows that share an id are one document with several
    sets, of which that of the smallest key is compared for near-duplicates, and
    equal rows are all kept or all dropped. A row without an id is linked with
    nothing and kept, with a null component. An empty table gives no rows; other
    columns are ignored.
    """
    described = features(docs)
    rows = described.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # One row for each set: its smallest id, by a sum that is combined early.
    classes = staged(
        rows.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("representative")), "dedup-classes"
    )
    best = F.min_by(F.struct("bands", "sketch"), F.struct("key_a", "key_b"))
    stands = classes.select("key_a", "key_b", F.col("representative").alias("doc_id"))
    chosen = (
        rows.join(stands, ["key_a", "key_b", "doc_id"])
        .groupBy("doc_id")
        .agg(best.alias("best"), F.min(F.struct("key_a", "key_b")).alias("key"))
        .select("doc_id", "best.bands", "best.sketch")
    )
    chosen = staged(chosen, "dedup-representatives")
    candidates = connected_components(candidate_pairs(chosen))
    members = candidates.select(F.col("node").alias("doc_id"), "component")
    unique = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    confirmed = links(unique, members)
    # An id with several sets connects their classes.
    several = rows.join(classes, ["key_a", "key_b"]).where("doc_id <> representative")
    several = several.join(stands.select("doc_id"), "doc_id", "left_semi").select(
        F.col("doc_id").alias("a"), F.col("representative").alias("b")
    )
    groups = connected_components(confirmed.unionByName(several)).select(
        F.col("node").alias("representative"), "component"
    )
    of_class = classes.join(groups, "representative", "left").select(
        "key_a", "key_b", F.coalesce("component", "representative").alias("component")
    )
    placed = described.join(of_class, ["key_a", "key_b"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (F.col("doc_id").isNull() | (component == F.col("doc_id"))).alias("kept"),
    )
