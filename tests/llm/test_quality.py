import re
from collections import Counter

import pytest

from weirflow.llm import quality


def brute(text):
    """The base measures, by plain loops."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    found = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if found[w] > 1 for k in range(8)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(inside),
    )


PROSE = "the house of the king was on a hill and all that he had to do was to look at it with care, but he did not."
TEXTS = [
    None,
    "",
    " \t\r\n\x0b\x0c ",
    PROSE,
    "a " * 9,
    "a " * 5_000,
    "x y " * 10 + "z",
    PROSE + "\n" + PROSE + "\nother words stand here",
    "one two three four five six seven eight nine " * 2 + PROSE,
    "é ü \x85 # | <b> ** words & 100 % $",
    "w" * 200_000,
    "line\n\n line\nline\nline \n",
    " ".join(str(i % 997) for i in range(30_000)),
]


def test_measures_equal_brute_force(docs_of):
    docs = docs_of([*enumerate(TEXTS), (None, PROSE), (3, PROSE)])
    found = quality.judge(docs).collect()
    got = sorted(tuple(r)[1:6] for r in found)
    assert got == sorted(brute(t) for t in [*TEXTS, PROSE, PROSE])
    assert sum(r.doc_id is None for r in found) == 1 and sum(r.doc_id == 3 for r in found) == 2
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (r.broken_rules == "")


@pytest.mark.parametrize(
    ("text", "lang", "broken"),
    [
        (PROSE, "en", ""),
        (PROSE.title(), None, ""),
        (PROSE.upper() + "!", "en", ""),
        ("le roi et la reine de ce pays ne sont pas dans le château mais sur la route qui va vers les montagnes bleues", "fr", ""),
        (PROSE.replace(" ", " & "), "en", "word_length,symbols"),
        (PROSE.replace(" ", "!! "), "en", "exclamations"),
        (" ".join(f"{c}rfgt{c}" for c in "bcdfghjklmnpqrstvwxz"), "en", "stop_words"),
        (" ".join(f"{c}rfgt{c}" for c in "bcdfghjklmnpqrstvwxz"), "fi", ""),
        ("a b c d e f g h i j k l m n o p q r s t u v w x y z", "en", "word_length"),
        ("\n".join([*["the one line"] * 3, *PROSE.split(",")]), "en", "repeated_lines"),
        ("the end", "en", "too_few_words"),
        (PROSE + " " + PROSE, "en", "repeated_words"),
    ],
)
def test_rules(docs_of, text, lang, broken):
    (row,) = quality.judge(docs_of([(1, text, lang, "s")])).collect()
    assert row.broken_rules == broken


def test_own_table_of_rules(docs_of):
    rules = (quality.Rule("long_enough", "n_words", "one", least=3_000),)
    kept = quality.judge(docs_of([(1, PROSE), (2, " ".join(map(str, range(40))))]), rules)
    assert {r.doc_id: r.kept for r in kept.collect()} == {1: False, 2: True}


def test_one_projection_without_shuffle_or_python(docs_of, spark, capsys):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    quality.judge(docs).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert quality.judge(docs.where("false")).collect() == []
