"""Blocks of vectors, and the search of query groups over all blocks.

Candidates are packed into blocks of at most BLOCK rows, each with the index
that a method builds for it, and queries into groups of at most GROUP. Every
group meets every block: the stated queries against all rows, in blocks. A pair
of a group and a block is one row of a join, so memory is bounded by one of
each; the best rows of a query over all blocks are cut to k before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import staged

BLOCK, GROUP = 16_384, 256
# Components that a block or a group holds, about 64 MB.
VALUES = 1 << 23
_BLOCKS = "block string, n int, dims int, ids binary, vectors binary, index binary"
_GROUPS = "query_group string, n int, dims int, ids binary, vectors binary"
_HITS = "query_id long, vec_id long, score {kind}"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part: neither is
    null, and no component is null, NaN or infinite. Empty vectors are out."""
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite
    )


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and a matrix of at most ``size`` rows, and of about VALUES components
    (one row may have more). Rows wait with those of about their length and end in
    zeros: a long vector pads no short ones, and vectors of one length have one
    width, hence the same rounding, in all blocks."""
    waiting: dict[int, list[pa.RecordBatch]] = {}
    rows: dict[int, int] = {}
    for batch in batches:
        lengths = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        widths = _widths(lengths)
        for kind in np.unique(widths).tolist():
            some = batch if (widths == kind).all() else batch.take(pa.array(np.flatnonzero(widths == kind)))
            most = max(1, min(size, VALUES // kind))
            while some.num_rows:
                part = some.slice(0, most - rows.get(kind, 0))
                waiting.setdefault(kind, []).append(part)
                rows[kind] = rows.get(kind, 0) + part.num_rows
                some = some.slice(part.num_rows)
                if rows[kind] == most:
                    yield _stacked(waiting.pop(kind), kind)
                    del rows[kind]
    for kind in sorted(waiting):
        yield _stacked(waiting[kind], kind)


def _widths(lengths: np.ndarray) -> np.ndarray:
    """The next number that is 2^n or 3 * 2^n."""
    above = 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64)
    return np.where(4 * lengths <= 3 * above, 3 * above // 4, above)


def _stacked(kept: list[pa.RecordBatch], width: int) -> tuple[np.ndarray, np.ndarray]:
    table = pa.Table.from_batches(kept)
    ids = table.column("vec_id").to_numpy().astype(np.int64)
    lists = table.column("embedding").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    matrix = np.zeros((len(ids), width))
    matrix[np.arange(width) < lengths[:, None]] = values
    return ids, matrix


def _packed_row(ids: np.ndarray, matrix: np.ndarray, keep_vectors: bool = True) -> dict:
    kept = np.ascontiguousarray(matrix, "<f8").tobytes() if keep_vectors else b""
    return {
        "n": pa.array([len(ids)], pa.int32()),
        "dims": pa.array([matrix.shape[1]], pa.int32()),
        "ids": [ids.tobytes()],
        "vectors": [kept],
    }


def pack_blocks(
    vectors: DataFrame,
    build: Callable[[np.ndarray], bytes],
    rows: int,
    keep_vectors: bool,
    size: int = BLOCK,
) -> DataFrame:
    """Blocks of ``vectors`` (from ``usable``, ``rows`` rows), in the order of
    their ids, with what ``build`` makes of each matrix; staged."""

    def pack(batches):
        for ids, matrix in _chunks(batches, size):
            order = np.argsort(ids, kind="stable")
            ids, matrix = ids[order], matrix[order]
            row = {"block": [_name(ids)]} | _packed_row(ids, matrix, keep_vectors)
            yield pa.RecordBatch.from_pydict(row | {"index": [build(matrix)]})

    return staged(_dealt(vectors, rows, size).mapInArrow(pack, _BLOCKS), "vector-blocks")


def pack_groups(queries: DataFrame, rows: int, size: int = GROUP) -> DataFrame:
    """Query groups, staged."""

    def pack(batches):
        for ids, matrix in _chunks(batches, size):
            yield pa.RecordBatch.from_pydict({"query_group": [_name(ids)]} | _packed_row(ids, matrix))

    return staged(_dealt(queries, rows, size).mapInArrow(pack, _GROUPS), "vector-groups")


def _name(ids: np.ndarray) -> str:
    return f"{ids[0]}-{ids[-1]}-{np.bitwise_xor.reduce(ids)}"


def _dealt(vectors: DataFrame, rows: int, size: int) -> DataFrame:
    """In turn, so that every partition fills about one block, however often an
    id or a vector is repeated."""
    return vectors.repartition(max(1, -(-rows // size)))


def _matrix(row: dict, dims: int) -> np.ndarray:
    """The first ``dims`` components."""
    if not row["vectors"]:
        return np.zeros((0, dims))
    return np.frombuffer(row["vectors"], "<f8").reshape(row["n"], row["dims"])[:, :dims]


def search_blocks(
    blocks: DataFrame,
    groups: DataFrame,
    search: Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray]],
    k: int,
    kind: str,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k best rows of each query.

    ``search(index, block_ids, block_matrix, query_ids, query_matrix)`` gives
    positions in the block, positions of queries and scores. Both matrices end
    where the narrower one does: beyond, products are zero. Ties go to the
    smaller vec_id. Where an id occurs twice, each of its rows is a row.
    """
    # Each group is dealt to all numbers of blocks, and meets the blocks there by
    # an equality join: blocks travel once, groups are the smaller rows.
    parts = max(1, blocks.count())
    numbered = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(parts)))
    slots = F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))
    dealt = groups.select(F.struct(*groups.columns).alias("group"), F.explode(slots).alias("slot"))
    # More partitions than blocks, so that few blocks share a task.
    wide = 4 * parts
    pairs = dealt.repartition(wide, "slot").hint("merge").join(numbered.repartition(wide, "slot"), "slot")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                group = row["group"]
                dims = min(row["dims"], group["dims"])
                block_ids = np.frombuffer(row["ids"], "<i8")
                query_ids = np.frombuffer(group["ids"], "<i8")
                at, query, score = search(
                    row["index"], block_ids, _matrix(row, dims), query_ids, _matrix(group, dims)
                )
                yield pa.RecordBatch.from_pydict(
                    {"query_id": query_ids[query], "vec_id": block_ids[at], "score": score}
                )

    hits = pairs.mapInArrow(run, _HITS.format(kind=kind))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
