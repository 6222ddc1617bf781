"""Keyed pseudonyms against Python's hmac, and where the key must not show."""

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from weirflow.operators.pseudonyms import Pseudonyms

KEY = b"\x01\x02secret-of-the-test-\xff\x00" * 2
TEXTS = ["", "a", "ä€😀", "x" * 100_000, "a\0b", " a ", None]


def expected(key, kind, text):
    return None if text is None else hmac.new(key, f"{kind}\0{text}".encode(), hashlib.sha256).hexdigest()


@pytest.mark.parametrize("key", [KEY[:16], KEY, KEY.ljust(64, b"k"), KEY * 3])
def test_pseudonyms_are_hmacs(spark, key):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    rows = Pseudonyms(spark, key).mask(df, {"text": "mail"}).orderBy("id").collect()
    assert [row.text for row in rows] == [expected(key, "mail", t) for t in TEXTS]


def test_kinds_and_keys_differ_and_equal_values_still_join(spark):
    names = Pseudonyms(spark, KEY)
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "text string")
    one, other = (names.mask(df, {"text": kind}) for kind in ("name", "name"))
    assert one.join(other, "text").count() == 5
    assert one.join(names.mask(df, {"text": "mail"}), "text").count() == 0
    assert one.join(Pseudonyms(spark, KEY[::-1]).mask(df, {"text": "name"}), "text").count() == 0


def test_a_short_key_and_an_unknown_column_are_refused(spark):
    with pytest.raises(ValueError, match="16"):
        Pseudonyms(spark, b"short")
    with pytest.raises(ValueError, match="mail"):
        Pseudonyms(spark, KEY).mask(spark.range(1), {"mail": "mail"})


def test_the_key_shows_in_no_plan(spark, tmp_path):
    spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string").write.parquet(f"{tmp_path}/t")
    df = Pseudonyms(spark, KEY).mask(spark.read.parquet(f"{tmp_path}/t"), {"text": "mail"})
    df = df.where(F.col("text") > "5").groupBy("text").count()
    df.collect()
    plans = df._jdf.queryExecution()
    text = " ".join([plans.toString(), plans.executedPlan().treeString(), plans.optimizedPlan().toString()]).lower()
    assert "scalar-subquery" in text
    block = KEY.ljust(64, b"\0")
    for pad in (0, 0x36, 0x5C):
        part = bytes(byte ^ pad for byte in block)[2:14]
        for shown in (part.hex(), part.hex(" "), str(list(part))[1:-1], part.decode("latin-1").lower()):
            assert shown not in text
