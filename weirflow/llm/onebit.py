"""Nearest neighbours by randomly rotated one-bit codes.

A vector is scaled to length one, turned by a random rotation in BITS or more
dimensions (random signs and Hadamard transforms), and kept as the signs of its components plus two scalars: its length
and the inner product of the turned vector with its own signs. From these follow
an unbiased estimate of the inner product with any query, and a bound of its
error that shrinks with the number of bits. The vectors whose bound reaches the
k-th best score found so far are scored exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.vectors import pack_blocks, pack_groups, search_blocks, usable

BITS = 256
# Standard errors that the bound allows for.
WIDTH = 1.9
SEED = 20240229
ROUNDS = 3
# Components that are turned or unpacked at once.
STEP_VALUES = 1 << 22


def room(dims: int, bits: int = BITS) -> int:
    """Dimensions that a vector is turned into: a power of two."""
    return 1 << (max(bits, dims, 2) - 1).bit_length()


def turned(matrix: np.ndarray, bits: int, seed: int = SEED) -> np.ndarray:
    """The rows, with zeros behind them, turned in ``bits`` dimensions: ROUNDS
    times random signs and a Hadamard transform. The turn follows from the seed
    alone, so nothing that grows with the vectors is kept or shipped."""
    n = len(matrix)
    out = np.zeros((n, bits))
    out[:, : matrix.shape[1]] = matrix
    signs = np.random.default_rng([seed, bits]).integers(0, 2, (ROUNDS, bits)) * 2.0 - 1
    for flips in signs:
        out *= flips
        half = 1
        while half < bits:
            pairs = out.reshape(n, -1, 2, half)
            left, right = pairs[:, :, 0], pairs[:, :, 1]
            total = left + right
            np.subtract(left, right, out=right)
            left[...] = total
            half *= 2
        out /= np.sqrt(bits)
    return out


def make_build(bits: int = BITS):
    def build(matrix):
        size = room(matrix.shape[1], bits)
        lengths = np.linalg.norm(matrix, axis=1)
        codes, own = [], []
        step = max(1, STEP_VALUES // size)
        for start in range(0, len(matrix), step):
            part = turned(matrix[start : start + step] / lengths[start : start + step, None], size)
            codes.append(np.packbits(part >= 0, axis=1).tobytes())
            own.append(np.abs(part).sum(axis=1) / np.sqrt(size))
        return lengths.astype("<f8").tobytes() + np.concatenate(own).astype("<f8").tobytes() + b"".join(codes)

    return build


def make_search(k: int, width: float = WIDTH):
    def search(index, block_ids, matrix, query_ids, query_matrix):
        n = len(block_ids)
        lengths, own = np.frombuffer(index, "<f8", 2 * n).reshape(2, n)
        codes = np.frombuffer(index, np.uint8, offset=16 * n).reshape(n, -1)
        bits = codes.shape[1] * 8
        scale = (lengths / own / np.sqrt(bits)).astype(np.float32)
        # Where the block's vectors end, a longer query adds nothing to a product.
        asked = turned(query_matrix[:, :bits], bits).astype(np.float32)
        estimates = np.empty((len(asked), n), np.float32)
        step = max(1, STEP_VALUES // bits)
        for start in range(0, n, step):
            signs = np.unpackbits(codes[start : start + step], axis=1).astype(np.float32) * 2 - 1
            estimates[:, start : start + step] = asked @ signs.T
        estimates *= scale
        spread = np.sqrt(np.maximum(0, 1 - own**2)) / own / np.sqrt(bits - 1) * lengths
        spread = (width * spread).astype(np.float32)
        sizes = np.linalg.norm(query_matrix, axis=1)
        out = []
        for i, q in enumerate(query_matrix):
            estimate = estimates[i]
            estimate[block_ids == query_ids[i]] = -np.inf
            rows = np.arange(n)
            if n > k:
                # Scores of the best estimates give a floor that all others must reach.
                top = np.argpartition(estimate, n - k)[n - k :]
                top = top[estimate[top] > -np.inf]
                floor = (matrix[top] * q).sum(axis=1).min() if len(top) == k else -np.inf
                # The margin covers the single precision of the estimates.
                rows = np.flatnonzero(estimate + spread * (sizes[i] * 1.0001) + 1e-5 * sizes[i] >= floor)
                rows = np.union1d(rows, top)
            rows = rows[estimate[rows] > -np.inf]
            # Row by row: equal vectors get equal scores wherever they stand.
            scores = (matrix[rows] * q).sum(axis=1)
            best = np.lexsort((block_ids[rows], -scores))[:k]
            out.append((rows[best], np.full(len(best), i), scores[best]))
        at, query, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return at, query, score

    return search


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, bits: int = BITS) -> DataFrame:
    """About the k rows of ``vectors`` with the largest inner product with each
    row of ``queries`` (both vec_id, embedding): query_id, rank, vec_id, score.

    Scores are inner products of the original vectors in double precision; only
    which rows are scored depends on the codes. Rows with the query's own id are
    no candidates; ties go to the smaller vec_id; a query with fewer candidates
    gets them all. Null ids, null, empty or zero vectors and those with a null,
    NaN or infinite component take no part, on either side. Where lengths
    differ, the shorter vector ends in zeros. A repeated row is a candidate each
    time, and a repeated query id shares one ranking. Empty inputs give no rows.
    Other columns are ignored.
    """
    some = F.exists("embedding", lambda x: x != 0)
    candidates, asked = usable(vectors).where(some), usable(queries).where(some)
    blocks = pack_blocks(candidates, make_build(bits), candidates.count(), keep_vectors=True)
    groups = pack_groups(asked, asked.count())
    found = search_blocks(blocks, groups, make_search(k), k, "double")
    return found.withColumn("rank", F.col("rank").cast("int"))
