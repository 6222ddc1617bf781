import os
import sys

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from weirflow.llm.queries import ORACLE_SQL, QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import differences, oracle  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    found, rows = differences(spark, oracle(SF), SF, QUERIES[name], ORACLE_SQL[name])
    assert found == []
    assert rows > 0


def test_pipeline_stages_and_result(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "source_mix", "packing"]
    packed = corpus_pipeline.run(spark, SF).collect()
    loads = {}
    for r in packed:
        loads[r.sequence_id] = loads.get(r.sequence_id, 0) + r.length
    assert packed and max(loads.values()) <= 2048


def test_each_stage_takes_effect(spark, docs_of):
    english = "the house and the garden are green and the sky is blue today number"
    german = "das haus und der garten sind grün und der himmel ist blau heute nummer"
    rows = [(i, f"{(english, german)[i % 2]} {i} {i} {i}", ("en", "de")[i % 2], f"s{i % 3}") for i in range(60)]
    rows += [(100, "12 34 !!", "en", "s0"), (101, None, "en", "s0"), (102, rows[0][1], "en", "s1"), (102, rows[0][1], "en", "s1")]
    docs = docs_of(rows)
    clashing = "lang_pred _id _source _taken _whole _rest _copy _given _copy_".split()
    docs = docs.selectExpr("*", *[f"concat('own ', doc_id) AS {name}" for name in clashing])
    columns = docs.columns
    kept = corpus_pipeline.identify_language(spark, docs, SF)
    assert kept.columns == columns
    assert sorted(r.doc_id for r in kept.collect()) == [*range(60), 102, 102]
    single = corpus_pipeline.drop_near_duplicates(spark, kept, SF)
    assert single.columns == columns
    from test_neardup import brute

    groups = brute([(d, t) for d, t, _, _ in rows if d not in (100, 101)])
    assert {r.doc_id for r in single.collect()} == {d for d, (_, c) in groups.items() if d == c}
    mixed = corpus_pipeline.mix_sources(spark, single, SF)
    assert mixed.columns == columns
    assert mixed.count() > 0
    texts = {r.doc_id: r.text for r in single.collect()}
    for stage in (kept, single, mixed):
        assert all(r.score == 7 and all(r[name] == f"own {r.doc_id}" for name in clashing) for r in stage.collect())
    assert corpus_pipeline.pack_sequences(spark, mixed, SF).count() >= mixed.count()
    assert all(texts[r.doc_id].startswith(r.text) and r.n_chars in (7, len(r.text)) for r in mixed.collect())
