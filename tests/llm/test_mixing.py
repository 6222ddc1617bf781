import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weirflow.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Share, stop the sources above the limit, share the excess, and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in stopped]
        left, share = total - sum(stopped.values()), sum(weight[s] for s in open_)
        targets = {s: left * weight[s] / share for s in open_}
        above = {s: most * sizes[s] for s in open_ if targets[s] > most * sizes[s]}
        if not above:
            return {**targets, **stopped}
        stopped |= above


ROWS = [(i, "w " * (i % 37), "en", f"s{i % 4}") for i in range(800)]
ROWS += [(1_000 + i, "a b c", "en", None) for i in range(5)]
ROWS += [(2_000, None, "en", "s1"), (2_001, " \t\x0b", "en", "empty"), (2_002, "x " * 3_000, "en", "éé")]
ROWS += [(None, "no id here", "en", "s2"), (3_000, "twice the same", "en", "s0"), (3_000, "twice the same", "en", "s0")]


@pytest.fixture
def found(docs_of):
    return mixing.mix_sources(docs_of(ROWS)).collect()


def test_targets_and_sizes(found):
    assert len(found) == len(ROWS)
    sizes = defaultdict(int)
    for _, text, _, source in ROWS:
        sizes[source] += len(WORD.findall(text or ""))
    targets = brute_targets(dict(sizes))
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])


def test_taken_comes_near_the_targets(found):
    taken, target = defaultdict(int), {}
    for r in found:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    for source, words in taken.items():
        assert abs(words - target[source]) <= max(5, 0.01 * target[source]), source


def test_taken_is_what_the_first_slots_cover(docs_of, found):
    """The schedule takes whole rounds of a source and then its first blocks."""
    epochs = defaultdict(set)
    for r in found:
        if r.size:
            epochs[r.source].add((r.taken // r.size, r.taken % r.size > 0))
    for values in epochs.values():
        rounds = {whole for whole, _ in values}
        assert max(rounds) - min(rounds) <= 1
        assert sum(part for _, part in values) <= 1


def test_reruns_agree(docs_of, found):
    again = mixing.mix_sources(docs_of(ROWS, parts=7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


@pytest.mark.parametrize("block", [1, 7, 100_000])
def test_any_block_size_respects_the_limits(docs_of, block):
    rows = [(i, "w " * 10, "en", f"s{i % 3}") for i in range(90)]
    found = mixing.mix_sources(docs_of(rows), block_words=block).collect()
    assert all(0 <= r.taken <= 3 * r.size for r in found)


def test_the_schedule_is_spread_evenly(docs_of):
    rows = docs_of(ROWS).select("source", F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0)).alias("size"))
    targets = mixing.source_targets(rows)
    shares, slots = mixing._shares(targets, 1)
    schedule = mixing.schedule_slots(shares, slots).orderBy("slot").collect()
    share = {r.source_no: r.expected / sum(x.expected for x in shares.collect()) for r in shares.collect()}
    counts = defaultdict(int)
    for r in schedule:
        assert r["rank"] == counts[r.source_no]
        counts[r.source_no] += 1
        n = r.slot + 1
        assert abs(counts[r.source_no] - share[r.source_no] * n) < 12


@pytest.mark.parametrize("millions", [2, 5, 10])
def test_small_sources_get_all_their_slots(spark, millions):
    """Sources of 1 to 20 blocks, stopped at three rounds, beside large ones."""
    small = {i: i for i in range(1, 21)}
    sizes = {0: millions * 300_000, **small, 21: millions * 350_000, 22: millions * 350_000}
    rows = [(f"s{no:02}", no, n, float(3 * n if no in small else n)) for no, n in sizes.items()]
    schema = "source string, source_no long, source_size long, target double"
    shares, slots = mixing._shares(spark.createDataFrame(rows, schema), 1)
    assert slots == sum(3 * n if no in small else n for no, n in sizes.items())
    found = mixing.schedule_slots(shares, slots).groupBy("source_no").count()
    counts = {r.source_no: r["count"] for r in found.collect()}
    assert counts == {no: 3 * n if no in small else n for no, n in sizes.items()}


def test_small_sources_have_small_blocks(docs_of):
    """A source below the size of a block still comes near its target."""
    rows = [(i, "w " * 10, "en", f"s{i % 2}") for i in range(400)]
    rows += [(1_000 + i, "w " * 4, "en", "tiny") for i in range(5)]
    rows += [(2_000 + i, "w " * 10, "en", f"t{i % 5}") for i in range(500)]
    taken, target = defaultdict(int), {}
    for r in mixing.mix_sources(docs_of(rows), block_words=1_024).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    for source, words in taken.items():
        assert abs(words - target[source]) <= max(1, target[source] / 16), source
    assert taken["tiny"] == 60


def test_rendering(docs_of):
    docs = docs_of([(i, f"a{i} b c d", "en", f"s{i % 3}") for i in range(30)]).select("doc_id", "text", "lang", "source")
    mix = mixing.mix_sources(docs, block_words=3)
    taken = {r.doc_id: r.taken for r in mix.collect()}
    words = defaultdict(int)
    for r in mixing.render_mix(docs, mix).collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert f"a{r.doc_id} b c d".startswith(r.text)
    assert words == {d: t for d, t in taken.items() if t}


def test_partial_takings_keep_their_characters(spark):
    docs = spark.createDataFrame([(1, " a\n\nb\tc  d", "s")], "doc_id long, text string, source string")
    mix = spark.createDataFrame([(1, "s", 4, 3)], "doc_id long, source string, size long, taken long")
    assert [r.text for r in mixing.render_mix(docs, mix).collect()] == [" a\n\nb\tc"]


def test_whole_documents_are_nearest_to_the_target(spark):
    rows = [(1, "s", 10, 10, 14.0), (2, "s", 10, 4, 14.0), (3, "t", 10, 20, 27.0), (4, "t", 10, 7, 27.0)]
    rows += [(5, None, 10, 2, 2.0), (6, None, 10, 0, 2.0), (7, "u", 0, 0, 0.0), (8, "v", 10, 26, 26.0)]
    mix = spark.createDataFrame(rows, "doc_id long, source string, size long, taken long, target double")
    found = {r.doc_id: r.taken for r in mixing.whole_documents(mix).collect()}
    assert found == {1: 10, 2: 0, 3: 20, 4: 10, 5: 10, 6: 0, 7: 0, 8: 30}


def test_the_pipeline_cuts_no_document(spark, docs_of):
    docs = docs_of([(i, f"a{i}\nb  " + "c " * (i % 30 + 20), "en", f"s{i % 3}") for i in range(60)])
    texts = {r.doc_id: r.text for r in docs.collect()}
    mixed = corpus_pipeline.mix_sources(spark, docs, None).collect()
    assert mixed and all(r.text == texts[r.doc_id] for r in mixed)
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3


def test_empty_tables_and_texts(docs_of):
    assert mixing.mix_sources(docs_of(ROWS).where("false")).collect() == []
    found = mixing.mix_sources(docs_of([(1, None), (2, "")])).collect()
    assert [(r.size, r.target, r.taken) for r in found] == [(0, 0.0, 0)] * 2
