import json

import pytest
from pyspark.sql import types as T

from weirflow.sources import read_csv, read_json_array, read_json_lines, static_dim

SCHEMA = T.StructType(
    [
        T.StructField("amount", T.DoubleType()),
        T.StructField("id", T.LongType()),
        T.StructField("note", T.StringType()),
    ]
)
ROWS = [
    {"id": 1, "amount": 1.5, "note": "plain"},
    {"id": 2, "amount": None, "note": 'say \\"hi\\" [x], y'},
    {"id": 3, "note": "line\nbreak \\\\"},
    {"id": None, "amount": -2.0, "note": ""},
]


def whole(spark, path):
    return spark.read.option("multiLine", True).schema(SCHEMA).json(path)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("indent", [None, 2])
def test_array_is_read_as_objects(spark, tmp_path, indent, split):
    path = str(tmp_path / "a.json")
    with open(path, "w") as out:
        json.dump(ROWS, out, indent=indent)
    df = read_json_array(spark, path, SCHEMA, split=split)
    assert content(df) == content(whole(spark, path))
    assert df.count() == len(ROWS)


@pytest.mark.parametrize(
    "text",
    [
        '[{"id": 1, "note": "a } b"}, {"id": 2}]',
        '[{"id": 1, "note": "a }{ b"}, {"id": 2}]',
        '[{"id": 1, "note": {"deep": 1}}, {"id": 2}]',
        '[null, {"id": 2}]',
        '[{"id": 1}, {"id": 2, "amount": 12',
        '[{"id": 1}, {"id": 2}',
        '[{"id": 1}, {"id": 2 "amount": 2}]',
        '{"id": 1, "note": "no array"}',
        '[{"id": 1}, 5]',
        "nonsense",
        '[{"id": 1, "note": "\\"}, {"id": 2, "note": "}"}]',
    ],
)
def test_other_documents_are_read_whole_and_refuse_to_be_cut(spark, tmp_path, text):
    path = str(tmp_path / "a.json")
    with open(path, "w") as out:
        out.write(text)
    assert content(read_json_array(spark, path, SCHEMA)) == content(whole(spark, path))
    with pytest.raises(Exception, match="braces|Malformed|MALFORMED"):
        read_json_array(spark, path, SCHEMA, split=True).collect()


def test_cutting_needs_a_schema(spark, tmp_path):
    with pytest.raises(ValueError, match="schema"):
        read_json_array(spark, str(tmp_path), split=True)


def test_empty_array_and_several_documents(spark, tmp_path):
    for name, rows in (("a", []), ("b", ROWS[:1]), ("c", ROWS[1:])):
        (tmp_path / f"{name}.json").write_text(json.dumps(rows))
    for split in (False, True):
        assert read_json_array(spark, str(tmp_path / "a.json"), SCHEMA, split=split).count() == 0
        found = read_json_array(spark, str(tmp_path), SCHEMA, split=split)
        assert content(found) == content(whole(spark, str(tmp_path)))


def test_a_large_document_is_shared_by_tasks(spark, tmp_path):
    path = str(tmp_path / "a.json")
    with open(path, "w") as out:
        json.dump([{"id": i, "amount": i / 2, "note": f"n{i}"} for i in range(20_000)], out, indent=1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = read_json_array(spark, path, SCHEMA, split=True)
        assert df.rdd.getNumPartitions() > 4
        assert content(df) == content(whole(spark, path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_inferred_json_types(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[{"b": 1, "a": 2.5}]')
    assert [(f.name, f.dataType) for f in read_json_array(spark, str(path)).schema] == [
        ("a", T.DoubleType()),
        ("b", T.LongType()),
    ]


def test_json_lines(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"id": 1}\n{"id": 2, "note": "x"}\n')
    assert content(read_json_lines(spark, str(path), SCHEMA)) == [(None, 1, None), (None, 2, "x")]


def test_csv_quotes_and_empty_fields(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('amount,id,note\n,1,"a, b"\n2.5,,\n')
    assert content(read_csv(spark, str(path), SCHEMA)) == [(2.5, None, None), (None, 1, "a, b")]


def test_literal_rows(spark):
    assert content(static_dim(spark, [(1.0, 1, "x")], SCHEMA)) == [(1.0, 1, "x")]
