import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark import cloudpickle

from weirflow.llm import bitsliced, onebit, vectors

SCHEMA = "vec_id long, embedding array<float>, rank string, score int, n int, block int"


def table(spark, pairs):
    return spark.createDataFrame([(i, v, "r", 1, 2, 3) for i, v in pairs], SCHEMA)


def usable(pairs):
    return [
        (i, np.array(v, np.float32).astype(float))
        for i, v in pairs
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]


def brute(pairs, queries, k, score):
    out = {}
    for q, v in queries:
        scored = [(-score(v, w), i) for i, w in pairs if i != q]
        out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return out


def found_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def whole(v, w):
    n = max(len(v), len(w))
    v, w = (np.pad(np.floor(256 * x).astype(int), (0, n - len(x))) for x in (v, w))
    return int(v @ w)


def make(seed, n=300, dims=12):
    rng = np.random.default_rng(seed)
    pairs = [(i, rng.normal(0, 0.3, dims).tolist()) for i in range(n)]
    pairs += [(n + i, [0.25] * dims) for i in range(20)]  # ties
    pairs += [(900, None), (901, []), (902, [None] + [0.1] * (dims - 1)), (903, [float("nan")] * dims)]
    pairs += [(904, [float("inf")] + [0.1] * (dims - 1)), (905, [0.0] * dims), (None, [1.0] * dims)]
    pairs += [(906, [2.0] * (dims - 3)), (907, [-1.0] * dims)]
    return pairs


@pytest.mark.parametrize("block", [64, 100, 16_384])
def test_bit_sliced_search_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(vectors.pack_blocks, "__defaults__", (block,))
    monkeypatch.setattr(vectors.pack_groups, "__defaults__", (7,))
    pairs = make(block)
    good = usable(pairs)
    queries = [(i, v) for i, v in good if i % 9 == 0 or i >= 900]
    df = table(spark, pairs)
    got = found_of(bitsliced.exact_top_k(df, df.where("vec_id % 9 = 0 OR vec_id >= 900"), 5))
    assert got == brute(good, queries, 5, whole)


def test_bit_sliced_search_with_few_candidates_and_repeats(spark):
    df = table(spark, [(1, [1.0, -1.0]), (2, [0.5, 0.5]), (2, [0.5, 0.5])])
    got = found_of(bitsliced.exact_top_k(df, df.where("vec_id = 1"), 5))
    assert got == {1: [(1, 2, 0), (2, 2, 0)]}
    assert bitsliced.exact_top_k(df.where("false"), df, 5).collect() == []
    assert bitsliced.exact_top_k(df, df.where("false"), 5).collect() == []
    assert bitsliced.exact_top_k(df.where("vec_id = 1"), df.where("vec_id = 1"), 5).collect() == []


@pytest.mark.parametrize("kind", ["float", "double"])
def test_components_of_any_finite_size(spark, kind):
    """Scores fit a long, whatever the components; others are larger than 2^63."""
    small = [(i, [float(i % 7) - 3, 0.5, 0.0]) for i in range(90)]
    large = [(100, [1e6, -2e6, 0.0]), (101, [-65_536.0, 65_535.99, 0.0]), (102, [3e6, 1.0, 0.0])]
    huge = [(103, [0.0, 0.0, -1e30]), (104, [0.0, 0.0, -3.0e38]), (105, [0.25, 0.25, -1e25])]
    df = spark.createDataFrame([*small, *large, *huge], f"vec_id long, embedding array<{kind}>")
    good = [(i, np.array(v, np.float32 if kind == "float" else float).astype(float)) for i, v in [*small, *large, *huge]]

    def score(v, w):
        return sum(math.floor(Fraction(x) * 256) * math.floor(Fraction(y) * 256) for x, y in zip(v.tolist(), w.tolist(), strict=True))

    queries = [(i, v) for i, v in good if i % 10 == 0 or i in (101, 102)]
    got = found_of(bitsliced.exact_top_k(df, df.where("vec_id % 10 = 0 OR vec_id IN (101, 102)"), 5))
    assert got == brute(good, queries, 5, score)
    with pytest.raises(Exception, match="does not fit a long"):
        bitsliced.exact_top_k(df, df.where("vec_id = 103"), 5).collect()


def test_full_adders_add():
    rng = np.random.default_rng(3)
    planes = [rng.integers(0, 1 << 63, (int(rng.integers(0, 9)), 2), np.uint64) for _ in range(6)]
    bits = lambda row: np.unpackbits(row.view(np.uint8), bitorder="little").astype(int)
    wanted = sum((bits(row) << w for w, rows in enumerate(planes) for row in rows), np.zeros(128, int))
    got = bitsliced._sum_slices(list(planes))
    assert (sum((bits(s) << w for w, s in enumerate(got) if s is not None), np.zeros(128, int)) == wanted).all()


def exact(v, w):
    n = max(len(v), len(w))
    return float((np.pad(v, (0, n - len(v))) * np.pad(w, (0, n - len(w)))).sum())


@pytest.mark.parametrize("block", [80, 16_384])
def test_one_bit_codes_find_the_nearest(spark, monkeypatch, block):
    monkeypatch.setattr(vectors.pack_blocks, "__defaults__", (block,))
    pairs = make(5, n=600, dims=32)
    good = [(i, v) for i, v in usable(pairs) if v.any()]
    queries = [(i, v) for i, v in good if i % 20 == 0]
    df = table(spark, pairs)
    got = found_of(onebit.nearest(df, df.where("vec_id % 20 = 0"), 20))
    wanted = brute(good, queries, 20, exact)
    assert got.keys() == wanted.keys()
    by_id = dict(good)
    hits = 0
    for q, rows in got.items():
        assert [r for r, _, _ in rows] == list(range(1, 21))
        assert [(-s, i) for _, i, s in rows] == sorted((-s, i) for _, i, s in rows)
        for _, i, s in rows:
            assert s == pytest.approx(exact(by_id[q], by_id[i]), abs=1e-12)
        hits += len({i for _, i, _ in rows} & {i for _, i, _ in wanted[q]})
    assert hits >= 0.97 * 20 * len(got)


def test_one_bit_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids = np.array([r.vec_id for r in rows])
    matrix = np.array([r.embedding for r in rows])
    got = found_of(onebit.nearest(df, df.where("vec_id % 20 = 0"), 20))
    hits = 0
    for q in ids[ids % 20 == 0]:
        scores = matrix @ matrix[ids == q][0]
        scores[ids == q] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -scores))[:20]]) & {i for _, i, _ in got[q]})
    assert hits >= 0.9 * 20 * len(got)


def test_one_bit_search_with_few_candidates(spark):
    df = table(spark, [(20, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [0.5, 0.5]), (4, [0.0, 0.0])])
    got = found_of(onebit.nearest(df, df.where("vec_id = 20"), 20))
    assert got == {20: [(1, 2, 0.5), (2, 3, 0.5)]}
    assert onebit.nearest(df.where("false"), df, 20).collect() == []
    assert onebit.nearest(df, df.where("false"), 20).collect() == []
    assert onebit.nearest(df.where("vec_id = 20"), df.where("vec_id = 20"), 20).collect() == []


def test_a_very_long_vector_among_short_ones(spark):
    """It neither widens the blocks of the others nor the rotation that they share."""
    rng = np.random.default_rng(11)
    pairs = [(i, rng.normal(0, 0.3, 12 + i % 3).tolist()) for i in range(400)]
    pairs += [(1000 + i, rng.normal(0, 0.05, 100_000).tolist()) for i in (0, 1)]
    pairs += [(1003, [0.5] * 100_000), (1004, [0.5] * 7)]
    good = usable(pairs)
    df = table(spark, pairs)
    asked = "vec_id % 40 = 0"
    queries = [(i, v) for i, v in good if i % 40 == 0]
    got = found_of(bitsliced.exact_top_k(df, df.where(asked), 5))
    assert got == brute(good, queries, 5, whole)
    got = found_of(onebit.nearest(df, df.where(asked), 20))
    wanted = brute(good, queries, 20, exact)
    by_id = dict(good)
    assert all(s == pytest.approx(exact(by_id[q], by_id[i]), abs=1e-9) for q, rows in got.items() for _, i, s in rows)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in rows}) for q, rows in wanted.items())
    assert hits >= 0.97 * 20 * len(wanted)


def test_blocks_are_as_wide_as_their_vectors(spark):
    pairs = [(i, [1.0] * (3 if i % 50 else 5_000 + i)) for i in range(1000)]
    df = vectors.usable(table(spark, pairs))
    rows = vectors.pack_blocks(df, lambda matrix: b"", 1000, keep_vectors=True).collect()
    assert sum(r.n for r in rows) == 1000
    assert {r.dims for r in rows} == {3, 6144}
    assert [vectors._widths(np.array([n]))[0] for n in (1, 2, 3, 4, 5, 7, 64, 65, 97, 768)] == [1, 2, 3, 4, 6, 8, 64, 96, 128, 768]


def test_the_turn_keeps_products_and_ships_nothing(spark):
    rng = np.random.default_rng(1)
    v, w = rng.normal(size=(5, 100)), rng.normal(size=(7, 100))
    assert np.allclose(onebit.turned(v, 256) @ onebit.turned(w, 256).T, v @ w.T)
    assert (onebit.turned(v, 256) == onebit.turned(v.copy(), 256)).all()
    # One component alone is spread over all.
    assert np.abs(onebit.turned(np.eye(1, 100), 256)).max() < 0.4
    assert [onebit.room(n) for n in (1, 256, 257, 100_000)] == [256, 256, 512, 131_072]
    assert len(cloudpickle.dumps((onebit.make_build(), onebit.make_search(20)))) < 100_000
