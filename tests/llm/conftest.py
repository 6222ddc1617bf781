import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text) pairs or (doc_id, text, lang, source)
    rows, with columns whose names the operators use inside."""

    def make(rows, parts=3):
        full = [(r + ("en", "s"))[:4] if len(r) < 4 else r for r in rows]
        schema = "doc_id long, text string, lang string, source string"
        df = spark.createDataFrame(full, schema).repartition(parts)
        clashing = "size shard slot chunk bucket component score rank item unit n_chars low key_a"
        return df.selectExpr("*", *[f"CAST(7 AS INT) AS {name}" for name in clashing.split()])

    return make
