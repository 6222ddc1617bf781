import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from weirflow.llm import neardup, shingles
from weirflow.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if text else []
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """Every pair that shares a shingle, compared on its full sets."""
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = defaultdict(list)
    for d in sorted(sets):
        common = Counter()
        for s in sets[d]:
            common.update(seen[s])
            seen[s].append(d)
        for e, n in common.items():
            if 100 * n >= 75 * (len(sets[d]) + len(sets[e]) - n):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def words(rng, n):
    return [f"w{rng.randrange(5_000)}" for _ in range(n)]


def noisy(rng, text, share):
    return [f"x{rng.randrange(10_000)}" if rng.random() < share else w for w in text]


def corpus(seed, dense=60):
    rng = random.Random(seed)
    rows = [(i, " ".join(words(rng, rng.choice([0, 1, 3, 4, 5, 6, 30, 120])))) for i in range(150)]
    base = words(rng, 150)
    rows += [(1_000 + i, " ".join(noisy(rng, base, rng.uniform(0, 0.06)))) for i in range(dense)]
    rows += [(2_000 + i, "The same TEXT for all of these rows".upper() if i % 2 else "the same text for all of these rows") for i in range(40)]
    for i in range(30):  # copies near the limit
        text = words(rng, 100)
        rows += [(3_000 + 2 * i, " ".join(text)), (3_001 + 2 * i, " ".join(noisy(rng, text, 0.03)))]
    shared = words(rng, 60)
    rows += [(4_000 + i, " ".join(words(rng, 40) + shared + words(rng, 40))) for i in range(30)]
    rows += [(5_000, None), (5_001, " \t\n"), (5_002, "One"), (5_003, "one"), (5_004, "long " * 20_000)]
    rng.shuffle(rows)
    return rows


def check(docs_of, rows):
    found = neardup.near_duplicates(docs_of(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)
    assert len(found) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(docs_of, seed):
    check(docs_of, corpus(seed))


def test_chunks_of_large_groups_lose_nothing(docs_of, monkeypatch):
    monkeypatch.setattr(neardup, "BUCKET_ROWS", 7)
    monkeypatch.setattr(neardup, "CHUNK_ROWS", 9)
    check(docs_of, corpus(3))


def test_rows_without_id_and_repeated_rows(docs_of):
    same = "one two three four five six seven"
    rows = [(None, same), (None, None), (1, same), (1, same), (2, same), (3, "other")]
    found = sorted(map(str, neardup.near_duplicates(docs_of(rows)).collect()))
    row = "Row(doc_id={}, n_shingles={}, component_id={}, kept={})".format
    expected = [
        row(None, 3, None, True), row(None, 0, None, True), row(1, 3, 1, True), row(1, 3, 1, True),
        row(2, 3, 1, False), row(3, 1, 3, True),
    ]
    assert found == sorted(expected)


def test_an_id_with_several_texts_connects_them(docs_of):
    a, b = "a b c d e f g h", "s t u v w x y z"
    found = neardup.near_duplicates(docs_of([(1, a), (2, a), (2, b), (3, b)])).collect()
    assert {r.component_id for r in found} == {1}


def test_empty_table(docs_of):
    assert neardup.near_duplicates(docs_of([(1, "x")]).where("false")).collect() == []


def test_sets_of_hashes_are_sets_of_shingles():
    texts = [t for _, t in corpus(4)] + ["tab\tand\x0bline\nféed É", "é É"]
    found = list(shingles.Hasher().sets(pa.array(texts)))
    expected = [shingle_set(t) for t in texts]
    assert [len(f) for f in found] == [len(e) for e in expected]
    for hashes, wanted in zip(found, expected, strict=True):
        for other, also in zip(found[:40], expected[:40], strict=True):
            assert len(np.intersect1d(hashes, other)) == len(wanted & also)


@pytest.mark.parametrize("size", [1, 2, 10, 100, 3_000])
def test_sketches_estimate_similarity(size):
    rng = np.random.default_rng(size)
    errors = []
    for _ in range(30):
        both = rng.integers(0, 1 << 62, size, np.uint64)
        extra = rng.integers(0, 1 << 62, size // 3, np.uint64)
        a, b = shingles.sketch(np.unique(both)), shingles.sketch(np.unique(np.concatenate([both, extra])))
        assert len(a) == shingles.COORDINATES
        errors.append((a == b).mean() - size / (size + size // 3))
    assert abs(np.mean(errors)) < 0.03
    assert np.max(np.abs(errors)) < 0.19


@pytest.mark.parametrize("n", [2, 3, 50])
def test_components_of_chains_stars_and_random_graphs(spark, n):
    rng = random.Random(n)
    chain = [(i, i + 1) for i in range(n)]
    star = [(1_000, 1_001 + i) for i in range(n)]
    rest = [(2_000 + rng.randrange(2 * n), 2_000 + rng.randrange(2 * n)) for _ in range(n)]
    edges = chain + star + rest
    parent = {x: x for e in edges for x in e}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    expected = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in found.collect()} == expected


def test_components_without_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
