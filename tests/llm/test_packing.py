import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from weirflow.llm import packing
from weirflow.llm.tokens import tokenizer_json

CAPACITY = 2048


def check(found, rows):
    full = Tokenizer.from_str(tokenizer_json())
    expected = []
    for doc_id, text in rows:
        ids = np.array(full.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, start in enumerate(range(0, len(ids), CAPACITY)):
            part = ids[start : start + CAPACITY]
            expected.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= CAPACITY
    return len(sequences)


def test_pieces_and_places(docs_of, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ITEMS", 60)
    rng = np.random.default_rng(1)
    rows = [(i, "word " * int(rng.integers(0, 1_500))) for i in range(200)]
    rows += [(1_000, None), (1_001, ""), (None, "no id"), (1_002, "same"), (1_002, "same")]
    rows += [(2_000, "long " * 10_000), (2_001, "a " * 2_047), (2_002, "a " * 2_048)]
    n = check(packing.pack_documents(docs_of(rows)).collect(), rows)
    total = sum(len((t or "").split()) + 1 for _, t in rows)
    assert n <= 1.06 * -(-total // CAPACITY)


def test_empty_table(docs_of):
    assert packing.pack_documents(docs_of([(1, "x")]).where("false")).collect() == []


def hard(seed, n=600):
    """Items for which best fit needs more bins than the bound."""
    return np.sort(np.random.default_rng(seed).integers(300, 900, n))[::-1].copy()


@pytest.mark.parametrize("seed", range(3))
def test_evolution_is_no_worse_than_best_fit_and_often_better(seed):
    lengths = hard(seed)
    plain = np.zeros(len(lengths), np.int64)
    fills = []
    packing.best_fit(lengths.tolist(), list(range(len(lengths))), plain, fills, CAPACITY)
    first = packing.Island(lengths, 1)
    elite = first.evolve([])
    second = packing.Island(lengths, 2)
    best = second.evolve([elite, plain])
    loads = np.bincount(best, lengths)
    assert loads.max() <= CAPACITY and loads.min() > 0
    assert packing.lower_bound(lengths) <= len(loads) <= len(fills)
    assert second.best[0] >= max(packing._fitness(np.array(fills), CAPACITY), first.best[0])


def test_crossover_keeps_every_item_once_and_bins_within_bounds():
    lengths = hard(7)
    island = packing.Island(lengths, 3)
    island._sown(0.0)
    island._sown(0.3)
    (_, a), (_, b) = island.people
    for _ in range(20):
        child = island.crossover(a, b)
        loads = np.bincount(child, lengths)
        assert child.min() == 0 and loads.max() <= CAPACITY and loads.min() > 0


def test_lower_bound_never_exceeds_a_packing():
    for seed in range(30):
        rng = np.random.default_rng(seed)
        lengths = rng.integers(1, CAPACITY, int(rng.integers(1, 40)))
        bins, fills = np.zeros(len(lengths), np.int64), []
        order = np.argsort(-lengths).tolist()
        packing.best_fit(lengths.tolist(), order, bins, fills, CAPACITY)
        assert -(-int(lengths.sum()) // CAPACITY) <= packing.lower_bound(lengths) <= len(fills)


def fewest(lengths, capacity):
    """The optimum, by trying every bin for every item."""
    best = len(lengths)

    def place(at, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if at == len(lengths):
            best = len(fills)
            return
        for i in range(len(fills)):
            if fills[i] + lengths[at] <= capacity:
                place(at + 1, fills[:i] + [fills[i] + lengths[at]] + fills[i + 1 :])
        place(at + 1, [*fills, lengths[at]])

    place(0, [])
    return best


def test_small_groups_reach_the_optimum_of_an_exhaustive_search():
    """Of them, best fit misses some."""
    missed = 0
    for seed in range(60):
        rng = np.random.default_rng(seed)
        lengths = np.sort(rng.integers(20, 60, 10))[::-1].copy()
        optimum = fewest(lengths.tolist(), 100)
        fills = []
        packing.best_fit(lengths.tolist(), list(range(10)), np.zeros(10, np.int64), fills, 100)
        missed += len(fills) > optimum
        first, second = packing.Island(lengths, seed, 100), packing.Island(lengths, seed + 1_000, 100)
        guest = first.evolve([])
        bins = second.evolve([guest])
        assert packing.lower_bound(lengths, 100) <= optimum
        assert len(np.unique(bins)) == optimum
    assert missed > 0


def test_what_groups_leave_is_packed_across_them(docs_of, monkeypatch):
    """Eight groups of some fifty documents: half a sequence of every group would be
    lost without the second round, which is one group of their emptiest sequences."""
    monkeypatch.setattr(packing, "GROUP_ITEMS", 50)
    rng = np.random.default_rng(4)
    rows = [(i, "word " * int(rng.integers(0, 600))) for i in range(400)]
    docs = docs_of(rows)
    monkeypatch.setattr(packing, "SPARE_BINS", 0)
    apart = check(packing.pack_documents(docs).collect(), rows)
    monkeypatch.setattr(packing, "SPARE_BINS", 2)
    together = check(packing.pack_documents(docs).collect(), rows)
    total = sum(len((t or "").split()) + 1 for _, t in rows)
    assert -(-total // CAPACITY) <= together < apart
