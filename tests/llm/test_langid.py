import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirflow.llm import langid
from weirflow.llm.queries import QUERIES


def test_forward_sums_all_segmentations():
    pieces = sorted(["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "aba"])
    probabilities = np.linspace(0.05, 0.2, len(pieces))
    model = langid.Model(["x"], pieces, np.log(probabilities)[:, None])
    known = dict(zip(pieces, probabilities, strict=True))

    def total(text):
        if not text:
            return 1.0
        found = sum(p * total(text[len(w) :]) for w, p in known.items() if text.startswith(w))
        return found + (0 if text[0] in known else langid.OTHER * total(text[1:]))

    words = ["a", "ab", "abab", "bababa", "c", "acb", "aaaa"]
    logs, n = langid.Scorer(model).scores(words)
    assert n.tolist() == [1] * len(words)
    assert logs[:, 0] == pytest.approx([math.log(total("▁" + w)) for w in words])


def test_fitting_raises_the_likelihood():
    counts = {"x": Counter({"abab": 5, "ab": 9, "ba": 2}), "y": Counter({"ba": 8, "baba": 4})}
    pieces = sorted(["▁", "a", "b", "ab", "ba", "▁ab", "▁ba"])

    def likelihood(model):
        out = []
        for i, lang in enumerate(model.languages):
            logs, _ = langid.Scorer(model).scores(list(counts[lang]))
            out.append(sum(n * logs[j, i] for j, n in enumerate(counts[lang].values())))
        return np.array(out)

    steps = [likelihood(langid.fit(counts, pieces, rounds)) for rounds in range(4)]
    for a, b in zip(steps, steps[1:], strict=False):
        assert (b >= a - 1e-9).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op1_unigram_language"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


DOCS = [(i, t, lang, "s") for i, (t, lang) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de")] * 20)]


def test_texts_without_letters_and_other_edges(docs_of):
    model = langid.learn(docs_of(DOCS + [(900, "null label", None, "s"), (901, None, "en", "s"), (None, "no id", "fr", "s")]))
    assert model.languages == ["de", "en"]
    texts = [None, "", "123 !!", "²³", "_", "der garten", "The House", "日本", "x" * 300_000, "the " * 50_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "und der")]
    df = docs_of(rows + rows[:1]).withColumnRenamed("rank", "lang_pred")
    found = langid.identify(df, model)
    assert [c for c in found.columns if c in ("lang_pred", "score")] == ["lang_pred", "score"]
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert found.count() == len(rows) + 1
    assert [by_id[i] for i in range(5)] == [("und", 0.0)] * 5
    assert (by_id[5][0], by_id[6][0], by_id[9][0], by_id[None][0]) == ("de", "en", "en", "de")
    assert by_id[7][0] in model.languages and by_id[9][1] > 0.99


def test_a_repeated_id_is_one_document_of_the_sample(docs_of, monkeypatch):
    """However often it occurs and whatever its hash."""
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 5)
    fitted = []
    monkeypatch.setattr(langid, "fit", lambda counts, pieces: fitted.append(counts))
    single = [(i, f"word{'abcdefghij'[i % 10]}", "en", "s") for i in range(40)]
    langid.learn(docs_of(single), [])
    langid.learn(docs_of(single * 8), [])
    assert fitted[-1] == fitted[0]
    assert fitted[0]["en"].total() == 5


def test_no_labels_and_no_rows(docs_of):
    model = langid.learn(docs_of([(1, "some text", None, "s")]))
    assert model.languages == []
    assert [r.lang_pred for r in langid.identify(docs_of([(1, "some text")]), model).collect()] == ["und"]
    assert langid.identify(docs_of([(1, "x")]).where("false"), model).collect() == []


def test_forgetting_words_changes_nothing(monkeypatch):
    model = langid.fit({"x": Counter(["alpha", "beta"]), "y": Counter(["gamma"])}, langid.vocabulary())
    texts = ["alpha beta gamma delta", "beta", None, "alpha alpha"]
    whole = langid.Scorer(model).scores(texts)[0]
    monkeypatch.setattr(langid, "KNOWN_WORDS", 2)
    scorer = langid.Scorer(model)
    for _ in range(2):
        assert np.allclose([scorer.scores([t])[0][0] for t in texts], whole)


def test_the_sample_is_that_of_the_smallest_hashes_however_it_is_dealt(docs_of, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 7)
    fitted = []
    monkeypatch.setattr(langid, "fit", lambda counts, pieces: fitted.append(counts))
    rows = [(i, "w" + "abcdefghij"[i // 10] + "abcdefghij"[i % 10], "en", "s") for i in range(100)]
    for parts, dealt in [(1, 1), (40, 2), (9, 32)]:
        monkeypatch.setattr(langid, "SAMPLE_PARTS", dealt)
        langid.learn(docs_of(rows, parts), [])
    ids = docs_of(rows).where(~langid.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).limit(7)
    expected = {r.text for r in ids.select("text").collect()}
    assert [set(counts["en"]) for counts in fitted] == [expected] * 3
