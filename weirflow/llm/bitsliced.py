"""Exact top-k search by inner product on a bit-sliced index.

Every component becomes an integer. A block of rows keeps, for each component,
one bitmap per binary digit of its distance from the block's smallest value.
The scores of a query are summed for all rows at once: each binary digit of a
query component adds the bitmaps of that component at its weight, and the
bitmaps of one weight are added by full adders, that is by bitmap arithmetic.
The slices of the sum then select the best rows from the most significant one
downward; rows that no slice tells apart are ties and go by id.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.vectors import pack_blocks, pack_groups, search_blocks, usable

SCALE = 256
# Below this, sums of products fit a long for any usual length; beyond it, numbers
# are Python's, which have no bounds.
LARGEST = 1 << 24


def _whole(x: float) -> int:
    """floor(256 * x), exactly."""
    return int(x) * SCALE if abs(x) >= 1 << 53 else math.floor(x * SCALE)


def _integers(matrix: np.ndarray) -> np.ndarray:
    if not matrix.size or np.abs(matrix).max() < LARGEST / SCALE:
        return np.floor(matrix * SCALE).astype(np.int64)
    out = np.empty(matrix.shape, object)
    out.ravel()[:] = [_whole(x) for x in matrix.ravel().tolist()]
    return out


def build_slices(matrix: np.ndarray) -> bytes:
    """Smallest value and number of digits of each component as JSON, behind its
    length, then the bitmaps of each from the lowest digit on, as little-endian
    64-bit words."""
    whole = _integers(matrix)
    least = [int(x) for x in whole.min(axis=0)]
    above = whole - whole.min(axis=0)
    digits = [int(x).bit_length() for x in above.max(axis=0)]
    words = -(-len(whole) // 64)
    planes = np.zeros((sum(digits), words * 8), np.uint8)
    at = 0
    for column, size in zip(above.T, digits, strict=True):
        for digit in range(size):
            bits = np.packbits((column >> digit & 1).astype(np.uint8), bitorder="little")
            planes[at, : len(bits)] = bits
            at += 1
    head = json.dumps([least, digits]).encode()
    head += b" " * (-len(head) % 8)
    return len(head).to_bytes(8, "little") + head + planes.tobytes()


def _sum_slices(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Add up bitmaps by weight (columns[w] holds those of weight 2^w) with full
    adders, three bitmaps of one weight at a time; one bitmap per weight is left."""
    slices: list[np.ndarray] = []
    w = 0
    while w < len(columns):
        here = columns[w]
        carries = []
        while len(here) > 1:
            n = len(here) // 3
            if n:
                a, b, c = here[:n], here[n : 2 * n], here[2 * n : 3 * n]
                either = a ^ b
                carries.append(a & b | either & c)
                here = np.concatenate([here[3 * n :], either ^ c])
            else:
                carries.append(here[:1] & here[1:])
                here = here[:1] ^ here[1:]
        slices.append(here[0] if len(here) else None)
        if carries:
            if w + 1 == len(columns):
                columns.append(carries[0][:0])
            columns[w + 1] = np.concatenate([columns[w + 1], *carries])
        w += 1
    return slices


def _select(slices: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of ``rows`` (a bitmap), ties in ascending order."""
    sure, open_rows = np.zeros_like(rows), rows
    if int(np.bitwise_count(rows).sum()) > k:
        for digit in reversed(slices):
            if digit is None:
                continue
            ones = open_rows & digit
            both = sure | ones
            n = int(np.bitwise_count(both).sum())
            if n > k:
                open_rows = ones
            else:
                sure, open_rows = both, open_rows & ~digit
                if n == k:
                    open_rows = np.zeros_like(rows)
                    break
    chosen = _positions(sure)
    ties = _positions(open_rows)[: max(0, k - len(chosen))]
    return np.concatenate([chosen, ties])


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _longs(score: np.ndarray) -> np.ndarray:
    """Scores outside of longs become the nearest one."""
    if score.dtype == object:
        score = np.array([min(max(int(x), _LEAST), _MOST) for x in score], np.int64)
    return score


def make_search(k: int):
    def search(index, block_ids, _, query_ids, query_matrix):
        start = 8 + int.from_bytes(index[:8], "little")
        least, digits = json.loads(index[8:start])
        dims = len(digits)
        rows = len(block_ids)
        words = -(-rows // 64)
        planes = np.frombuffer(index, "<u8", offset=start).reshape(-1, words)
        planes = np.concatenate([planes, ~planes])  # of the distance from above as well
        first = np.concatenate([[0], np.cumsum(digits)])
        below = first[-1]
        every = np.packbits(np.arange(words * 64) < rows, bitorder="little").view("<u8")
        queries = _integers(query_matrix)[:, :dims]
        out = []
        for i, q in enumerate(queries):
            weights: list[list[int]] = []
            constant = 0
            for d, value in enumerate(q.tolist()):
                if not value:
                    continue
                # A negative factor times v is a positive one times the distance
                # of v from above, and a constant.
                size, start = int(digits[d]), int(first[d])
                constant += value * (int(least[d]) + (0 if value > 0 else (1 << size) - 1))
                start += 0 if value > 0 else int(below)
                factor, shift = abs(value), 0
                while factor:
                    if factor & 1:
                        while len(weights) < shift + size:
                            weights.append([])
                        for digit in range(size):
                            weights[shift + digit].append(start + digit)
                    factor >>= 1
                    shift += 1
            slices = _sum_slices([planes[at] if at else planes[:0] for at in weights])
            own = block_ids == query_ids[i]
            others = every
            if own.any():
                packed = np.zeros(words * 64, bool)
                packed[:rows] = own
                others = every & ~np.packbits(packed, bitorder="little").view("<u8")
            at = _select(slices, others, k)
            small = len(slices) < 62 and abs(constant) < 1 << 62
            score = np.full(len(at), constant, np.int64 if small else object)
            for w, digit in enumerate(slices):
                if digit is not None:
                    bits = digit[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)
                    score += bits.astype(np.int64).astype(score.dtype) << w
            out.append((at, np.full(len(at), i), _longs(score)))
        return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True))

    return search


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The k rows of ``vectors`` with the largest integer inner product with each
    row of ``queries`` (both vec_id, embedding): query_id, rank, vec_id, score.

    A component x counts as floor(256 * x). Rows with the query's own id are no
    candidates; ties go to the smaller vec_id; a query with fewer candidates gets
    them all. Null ids, null or empty vectors and those with a null, NaN or
    infinite component take no part, on either side. Where lengths differ, the
    shorter vector ends in zeros. A repeated row is a candidate each time, and a
    repeated query id shares one ranking. Components may have any finite size; only
    a score among the best that does not fit a long is an error. Empty inputs give
    no rows. Other columns are ignored.
    """
    candidates = usable(vectors)
    asked = usable(queries)
    blocks = pack_blocks(candidates, build_slices, candidates.count(), keep_vectors=False)
    groups = pack_groups(asked, asked.count())
    found = search_blocks(blocks, groups, make_search(k), k, "long")
    outside = F.raise_error(F.lit("one of the best scores of a query does not fit a long")).cast("long")
    score = F.when(F.col("score").isin(_LEAST, _MOST), outside).otherwise(F.col("score"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))
