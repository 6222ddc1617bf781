import random
import re
import time
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from weirflow.llm import phrases
from weirflow.llm.trie import ROOT, DoubleArrayTrie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, first=2000):
    """The contract by plain loops over (lang, text)."""
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in frequent.items():
            inside = any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in frequent.items()
            )
            if not inside:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, text, left, right) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, text.decode(), -a, left, right, n[lang], -score))
    return out


def sample():
    r = random.Random(13)
    words = ["the", "The", "of", "new", "york", "times", "é", "l'été", "x\x0by", "a-b", "\x85"]
    rows = []
    for i in range(120):
        text = "".join(
            r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!", " : "]) for _ in range(r.randint(0, 60))
        )
        rows.append((i, text + " new york times square tower" * (i % 3), r.choice(["en", "en", "fr", None, "und"]), "s"))
    return rows + [(500, None, "en", "s"), (501, "", None, "s"), (None, "ha " * 300, "en", "s"), (3, *rows[3][1:]), (3, *rows[3][1:])]


@pytest.mark.parametrize("least", [2, 5, 40])
def test_collocations_equal_brute_force(docs_of, least):
    rows = sample()
    found = phrases.collocations(docs_of(rows), least).collect()
    assert sorted(map(tuple, found)) == sorted(brute([(lang, text) for _, text, lang, _ in rows], least))
    assert found[0].asDict().keys() == {"lang", "rank", "phrase", "a", "l", "r", "n", "score"}


def test_first_of_each_language(docs_of):
    rows = sample()
    found = phrases.collocations(docs_of(rows), 2, first=7).collect()
    assert sorted(map(tuple, found)) == sorted(brute([(lang, text) for _, text, lang, _ in rows], 2, 7))


def test_small_parts_and_flushes_change_nothing(docs_of, monkeypatch):
    rows = sample()
    wanted = sorted(brute([(lang, text) for _, text, lang, _ in rows], 4))
    monkeypatch.setattr(phrases, "PART_PHRASES", 20)
    monkeypatch.setattr(phrases, "HELD_COUNTS", 16)
    monkeypatch.setattr(phrases, "BITS", 64 * 4)  # nearly all bits are set
    assert sorted(map(tuple, phrases.collocations(docs_of(rows), 4).collect())) == wanted


def test_empty_and_rare(docs_of):
    assert phrases.collocations(docs_of([(1, "one two three")])).collect() == []
    assert phrases.collocations(docs_of([(1, "one two")]).where("false")).collect() == []
    assert phrases.collocations(docs_of([(1, None)])).collect() == []


def test_long_text(docs_of):
    found = phrases.collocations(docs_of([(1, "so far so good and " * 40_000)])).collect()
    assert sorted(map(tuple, found)) == sorted(brute([("en", "so far so good and " * 40_000)], 100))


def test_scores_beyond_64_bits(spark):
    a, n, left, right = 999_999_999_937, 3_000_000_000_000_000, 999_999_999_989, 1_000_000_000_039
    df = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    (row,) = df.select(phrases.score(*map(df.__getitem__, "anlr"))).collect()
    assert row[0] == 1000 * a * n // (left * right)


def test_trie_finds_exactly_its_sequences():
    r = random.Random(1)
    kept = list({tuple(r.randint(1, 40) for _ in range(r.randint(1, 4))) for _ in range(500)})
    trie = DoubleArrayTrie(kept)
    number = {s: i for i, s in enumerate(kept)}
    for _ in range(3_000):
        s = r.choice(kept) if r.random() < 0.5 else tuple(r.randint(0, 45) for _ in range(r.randint(1, 4)))
        state = np.array([ROOT])
        for code in s:
            state = trie.step(state, np.array([code])) if state[0] >= 0 else state
        found = trie.accepts[state[0]] if state[0] >= 0 else -1
        assert found == number.get(s, -1)
    assert (trie.step(np.array([ROOT]), np.array([10**6])) == -1).all()
    assert (DoubleArrayTrie([]).step(np.array([ROOT]), np.array([1])) == -1).all()


def test_bitmap_only_lets_too_much_through():
    hashes = np.random.default_rng(3).integers(0, 1 << 63, 1_000, np.uint64) * np.uint64(2)
    bitmap = np.zeros(64, np.uint64)
    for h in hashes.tolist():
        bitmap[h & 63] |= np.uint64(1 << (h >> 58))
    assert phrases._seen(bitmap, hashes).all()


def test_words_end_with_their_text():
    words = phrases._Words(pa.array(["a b", "c", None, "", " d,e f"]), phrases.Hasher())
    assert words.written(np.arange(len(words.starts)), 1) == ["a", "b", "c", "d", "e", "f"]
    assert words.joined.tolist() == [True, False, False, False, True]


def test_words_that_a_task_counts_take_bounded_memory():
    pool, sums = pa.default_memory_pool(), Counter()
    tally, most, before = phrases._Tally(lang=pa.string(), text=pa.string()), 0, pa.total_allocated_bytes()
    tracemalloc.start()
    for i in range(0, 3_000_000, 50_000):
        hashes = phrases.mixed(np.arange(i, i + 50_000).astype(np.uint64))
        known = np.arange(50_000) < 10_000  # as every time
        hashes[known] = np.arange(10_000)
        texts = pa.array([f"{h:x}" for h in hashes.tolist()])
        for batch in tally.add(hashes, np.full(50_000, 2), pa.array(["en"] * 50_000), texts):
            assert len(batch) <= phrases.ROWS
            sums.update({"rows": len(batch), "n": sum(batch.column("n").to_pylist())})
        most = max(most, pa.total_allocated_bytes() - before + tracemalloc.get_traced_memory()[0])
    peak = tracemalloc.get_traced_memory()[1] + pool.max_memory()
    tracemalloc.stop()
    sums.update({"n": sum(sum(batch.column("n").to_pylist()) for batch in tally.taken())})
    assert sums["n"] == 6_000_000 and sums["rows"] > phrases.HELD_COUNTS
    assert most < 100_000_000 and peak < 300_000_000


def test_long_words_are_handed_over_early():
    tally = phrases._Tally(text=pa.string())
    rows = 0
    for i in range(100):
        rows += sum(map(len, tally.add(np.array([i], np.uint64), np.ones(1, np.int64), pa.array(["x" * 1_000_000]))))
        assert sum(column.nbytes for column in tally.columns) <= phrases.HELD_BYTES
    assert rows > 50


def test_frequent_words_are_found_without_a_sort(spark, docs_of):
    texts = docs_of([(1, "so far so good")]).selectExpr("text", "'en' AS lang", "1L AS lang_hash")
    words = phrases._words(texts, 1)
    assert "SortAggregate" not in words._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert sorted((r.lang, r.text, r.n) for r in words.collect()) == [("en", "far", 1), ("en", "good", 1), ("en", "so", 2)]


def test_tries_of_many_phrases_are_built_at_once():
    r = np.random.default_rng(6)
    often = 1 / np.arange(1, 20_001)
    pairs = r.permutation(20_000)[r.choice(20_000, (150_000, 2), p=often / often.sum())] + 1
    kept = [(1, *pair) for pair in np.unique(pairs, axis=0).tolist()]
    began = time.process_time()
    trie = DoubleArrayTrie(kept)
    assert time.process_time() - began < 8  # 26 s before, and four times that for twice as many
    states = np.full(len(kept), ROOT)
    for codes in np.array(kept).T:
        states = trie.step(states, codes)
    assert (trie.accepts[states] == np.arange(len(kept))).all()
    # Words of two codes keep children together.
    counter = phrases._Counter(pa.array(["en"] * len(kept)), pa.array([f"w{a} w{b}" for _, a, b in kept]))
    assert len(counter.trie.base) < 4 * len(kept)


def test_counts_of_a_task_follow_its_texts():
    r = np.random.default_rng(7)
    counts = np.zeros(2_000_000, np.int64)
    at = r.choice(len(counts), 1_000, replace=False)
    counts[at] = r.integers(1, 200, 1_000)
    counts[at[:3]] = [300, 70_000, 5_000_000_000]
    shards = list(phrases._shards(counts))
    assert sum(batch.nbytes for batch in shards) < 40_000
    chunks = defaultdict(list)
    for batch in shards:
        for i, chunk in enumerate(batch.column("chunk").to_pylist()):
            chunks[chunk].append(batch.slice(i, 1))
    total = np.zeros(len(counts), np.int64)
    for chunk, rows in chunks.items():
        for batch in phrases._summed((pa.scalar(chunk),), iter(rows * 2)):
            total[batch.column("place").to_numpy()] += batch.column("n").to_numpy()
    assert (total == 2 * counts).all()


def test_counter_meets_every_phrase(docs_of):
    rows = [("en", "a b c. a b"), ("fr", "a b"), ("xx", "a b c"), ("en", "b unknown c")]
    kept = [("en", "a"), ("en", "a b"), ("en", "a b c"), ("en", "c"), ("fr", "a b"), ("fr", "b a")]
    langs, texts = (pa.array([x[i] for x in kept]) for i in range(2))
    columns = [pa.array([x[i] for x in rows]) for i in (1, 0)]
    step = pa.RecordBatch.from_arrays([*columns, pa.array(range(4))], ["text", "lang", "lang_hash"])
    places, totals = Counter(), {}
    for batch in phrases._Counter(langs, texts)(iter([step])):
        for row in batch.to_pylist():
            if row["lang"] is None:
                places.update(dict(zip(np.frombuffer(row["places"], "<u2").tolist(), row["counts"], strict=True)))
            else:
                totals[row["lang"]] = row["n"]
    assert places == {0: 2, 1: 2, 2: 1, 3: 2, 4: 1} and totals == {"en": 8, "fr": 2, "xx": 3}


def test_tasks_get_small_batches_and_the_setting_is_kept(spark, docs_of):
    docs = docs_of([(i, "word " * 2_000) for i in range(2_000)]).coalesce(1)
    before = spark.conf.getAll.get(phrases.BATCH_SETTING)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    with phrases._small_batches(spark):
        found = [r.size for r in docs.select("text").mapInArrow(sizes, "size long").collect()]
    assert len(found) > 4 and max(found) < 2 * phrases.BATCH_BYTES
    assert spark.conf.getAll.get(phrases.BATCH_SETTING) == before
