import random

import pytest

from weirflow.operators import Quarantine, quarantine_incomplete

SCHEMA = "id int, name string, at int"
ROWS = [
    (1, "ok", 1),
    (3, "twice", 1),
    (3, "twice", 1),
    (5, None, 1),
    (7, "good copy", 2),
    (7, None, 1),
    (None, "no key", 1),
    (None, None, 2),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted((r["id"] for r in df.collect()), key=lambda v: (v is not None, v))


def test_one_incomplete_copy_taints_its_key(spark):
    split = Quarantine(frame(spark), "id", ["at"])
    assert ids(split.clean) == [1, 3]
    assert ids(split.duplicates) == [None, 3, 7]
    assert ids(split.invalid) == [None, None, 5, 7]


def test_row_scope_removes_only_the_incomplete_rows(spark):
    split = Quarantine(frame(spark), "id", ["at"], scope="row")
    assert ids(split.clean) == [1, 3, 7]
    newest_is_bad = frame(spark, [(7, None, 2), (7, "good copy", 1)])
    split = Quarantine(newest_is_bad, "id", ["at"], scope="row")
    for kept in (split.clean, split.clean_of_ranked):
        assert [tuple(r) for r in kept.collect()] == [(7, "good copy", 1)]


def test_keyless_rows_can_be_kept_as_well_as_rejected(spark):
    split = Quarantine(frame(spark), "id", ["at"], keep_null_keys=True)
    assert ids(split.clean) == ids(split.clean_of_ranked) == [None, 1, 3]
    assert ids(split.invalid).count(None) == 2
    split = quarantine_incomplete(frame(spark), "id", keep_null_keys=True)
    assert ids(split.clean) == [None, None, 1, 3, 3]


def test_unknown_scope_is_refused(spark):
    with pytest.raises(ValueError):
        quarantine_incomplete(frame(spark), "id", scope="table")


@pytest.mark.parametrize("scope", ["key", "row"])
@pytest.mark.parametrize("keep", [False, True])
def test_incomplete_split_equals_brute_force(spark, scope, keep):
    rng = random.Random(3)
    rows = []
    for _ in range(1500):
        key = rng.choice([0, None, rng.randrange(300)])
        name = None if rng.random() < (0.0 if key == 0 else 0.1) else f"n{rng.randrange(9)}"
        rows.append((key, name, 1))
    bad = [r for r in rows if None in r]
    tainted = {r[0] for r in bad if r[0] is not None}
    if scope == "key":
        clean = [r for r in rows if r[0] not in tainted and (None not in r or (keep and r[0] is None))]
    else:
        clean = [r for r in rows if None not in r or (keep and r[0] is None)]
    split = quarantine_incomplete(frame(spark, rows), "id", scope=scope, keep_null_keys=keep)
    assert sorted(map(repr, map(tuple, split.clean.collect()))) == sorted(map(repr, clean))
    assert sorted(map(repr, map(tuple, split.invalid.collect()))) == sorted(map(repr, bad))


@pytest.mark.parametrize("heavy_rows", [20, 10_000_000])
def test_nothing_is_lost_and_clean_keys_are_unique(spark, heavy_rows):
    rng = random.Random(5)
    rows = [
        (rng.choice([0, None, rng.randrange(200)]), rng.choice([None, *"abcdefgh"]), rng.randrange(4))
        for _ in range(1200)
    ]
    split = Quarantine(frame(spark, rows), "id", ["at"], heavy_rows=heavy_rows)
    clean = [tuple(r) for r in split.clean.collect()]
    assert sorted(clean, key=repr) == sorted(map(tuple, split.clean_of_ranked.collect()), key=repr)
    invalid = {tuple(r)[:3] for r in split.invalid.collect()}
    duplicates = {tuple(r)[:3] for r in split.duplicates.collect()}
    tainted = {r[0] for r in invalid}
    assert len({r[0] for r in clean}) == len(clean)
    assert not {r[0] for r in clean} & tainted
    for row in rows:
        assert row in clean or row in invalid or row in duplicates or row[0] in tainted
