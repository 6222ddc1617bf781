"""Versions of dimension rows, and facts as of their time, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from weirflow.operators.versions import enrich_as_of, versions

DAY = dt.date(2026, 1, 1)


def day(n):
    return DAY + dt.timedelta(n)


def generated():
    """(loads, facts): key 0 holds a third of the facts, some rows lack key or time."""
    r = random.Random(3)
    loads = {(r.randrange(12), day(7 * r.randrange(12))): r.choice(["a", "b", None]) for _ in range(90)}
    loads = [(k, state, date) for (k, date), state in loads.items()] + [(None, "x", DAY)]
    facts = []
    for i in range(600):
        key = 0 if i % 3 == 0 else r.choice([*range(14), None])
        time = None if r.random() < 0.1 else dt.datetime.combine(day(r.randrange(-9, 99)), dt.time(r.randrange(24)))
        facts.append((i // 2 if i % 50 else 1, key, time))
    return loads, facts


def brute(loads, facts, how):
    out = []
    for id_, key, time in facts:
        state = since = None
        if key is not None and time is not None:
            mine = sorted((date, s) for k, s, date in loads if k == key and date <= time.date())
            if mine:
                state = mine[-1][1]
                # The version began with the first of the last equal states.
                since = mine[-1][0]
                for date, s in reversed(mine):
                    if s != state:
                        break
                    since = date
        if since is not None or how == "left":
            out.append((id_, key, time, state, since))
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("heavy_rows, days", [(10**6, 30), (150, 5), (1, 30), (20, 1)])
def test_facts_get_the_version_of_their_time(spark, how, heavy_rows, days):
    loads, facts = generated()
    dim = versions(spark.createDataFrame(loads, "k int, state string, processing_date date"), ["k"], ["state"])
    source = spark.createDataFrame(facts, "id int, key int, time timestamp_ntz").withColumnRenamed("key", "k")
    got = enrich_as_of(source, dim, ["k"], "time", ["state"], how, heavy_rows, days)
    assert got.columns == ["id", "k", "time", "state", "valid_from"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(loads, facts, how)


def test_loads_without_a_change_start_no_version(spark):
    rows = [(1, "a", None, 0), (1, "a", None, 3), (1, "b", None, 5), (1, None, None, 7), (1, None, None, 8), (1, "a", 1, 9)]
    loads = spark.createDataFrame([(k, a, b, day(n)) for k, a, b, n in rows], "k int, a string, b int, on date")
    got = versions(loads, ["k"], ["a", "b"], since="on").orderBy("valid_from").collect()
    assert [tuple(r) for r in got] == [
        (1, "a", None, day(0), day(5)),
        (1, "b", None, day(5), day(7)),
        (1, None, None, day(7), day(9)),
        (1, "a", 1, day(9), None),
    ]


def test_empty_sides_and_clashing_names(spark):
    dim = versions(spark.createDataFrame([], "k int, state string, processing_date date"), ["k"], ["state"])
    facts = spark.createDataFrame([(1, DAY)], "k int, time date")
    assert [tuple(r) for r in enrich_as_of(facts, dim, ["k"], "time", ["state"]).collect()] == [(1, DAY, None, None)]
    assert enrich_as_of(facts.limit(0), dim, ["k"], "time", ["state"]).count() == 0
    with pytest.raises(ValueError, match="state"):
        enrich_as_of(facts.withColumn("state", F.lit(1)), dim, ["k"], "time", ["state"])


def test_only_versions_of_heavy_keys_are_repeated(spark):
    """A key of 2,000 facts in 100 stretches next to 5,000 keys of one fact."""
    dim = spark.range(5000).selectExpr(
        "id AS k", "'v' AS state", "DATE '2020-01-01' AS valid_from", "CAST(NULL AS DATE) AS valid_to"
    )
    facts = spark.range(7000).selectExpr(
        "id", "CASE WHEN id < 2000 THEN 7L ELSE id - 2000 END AS k", "DATE '2020-01-01' + CAST(id % 100 AS INT) AS time"
    )
    joined = enrich_as_of(facts, dim, ["k"], "time", ["state"], heavy_rows=1000, bucket_days=1)
    assert joined.where("state = 'v'").count() == 7000
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in text and "Join Cross" not in text
