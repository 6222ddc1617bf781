"""Quality rules: a table of thresholds compiled into Spark columns.

A rule bounds one measure of a text by a percentage of another, so that all
comparisons are between integers. Measures and rules are built-in functions
only; all that is known of a text is in its own row, and nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the measures: what parts words, what counts as a symbol, and
#: how many words a window for repetitions has.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
CLOSING = ".,;:!?"
WINDOW = 8

#: Frequent function words of the languages that the stop-word rule applies to.
STOP_WORDS = {
    "de": "aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer eines er es"
    " für hat ich im in ist mit nach nicht noch oder sich sie sind so und vom von vor war was werden wie wird zu zum zur",
    "en": "a all an and are as at be been but by for from had has have he her his i in is it its not of on or she that"
    " the their they this to was we were which will with you",
    "es": "al como con de del el ella en entre es esta este fue ha la las le lo los más no o para pero por que se sin"
    " sobre su sus un una y ya",
    "fr": "à au aux avec ce cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas"
    " plus pour qu que qui sa se ses son sont sur un une vous",
}


@dataclass(frozen=True)
class Rule:
    """``part`` has to be at least ``least`` and at most ``most`` percent of ``whole``."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None
    # Languages the rule is for; a text without one counts as any. None: all.
    langs: tuple[str, ...] | None = None


BASE_RULES = (
    Rule("too_few_words", "n_words", "one", least=2_000),
    Rule("repeated_words", "n_repeat_words", "n_words", most=30),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", least=250, most=1_200),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("exclamations", "n_exclamations", "n_words", most=30),
    Rule("stop_words", "n_stop_words", "n_words", least=4, langs=tuple(STOP_WORDS)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=30),
)


def breaks(rule: Rule) -> Column:
    """Whether a text breaks ``rule``; false where it is for other languages."""
    part, whole = 100 * F.col(rule.part), F.col(rule.whole)
    broken = F.lit(False)
    if rule.least is not None:
        broken = broken | (part < rule.least * whole)
    if rule.most is not None:
        broken = broken | (part > rule.most * whole)
    if rule.langs is not None:
        broken = broken & F.coalesce(F.col("lang").isin(*rule.langs), F.lit(True))
    return broken


def stop_words() -> list[str]:
    """The words as they are written inside sentences, at their start and in capitals."""
    lower = {word for line in STOP_WORDS.values() for word in line.split()}
    return sorted(lower | {word.capitalize() for word in lower} | {word.upper() for word in lower})


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the measures of every row of ``docs``."""
    words = F.col("words")
    stops = stop_words()
    cut = docs.select(
        "doc_id", "lang", F.coalesce("text", F.lit("")).alias("text")
    ).withColumns(
        {
            "words": F.regexp_extract_all("text", F.lit(WORD), F.lit(0)),
            "lines": F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)),
        }
    )
    counted = cut.select(
        "doc_id",
        "lang",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_exclamations"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(words, lambda w: F.rtrim(w, F.lit(CLOSING)).isin(*stops)))
        .cast("long")
        .alias("n_stop_words"),
        F.lit(1).cast("long").alias("one"),
    )
    return _repeats(counted).drop("words")


def _repeats(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words: the words in windows that are found twice or more.

    Windows are compared by a hash of the hashes of their words; only in texts
    where two of them agree are they sorted with their places, and neighbours
    that agree are compared word by word.
    """
    words, windows, ranked, starts = map(F.col, ("words", "windows", "ranked", "starts"))

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)])

    def same(one: Column, other: Column) -> Column:
        return (one.h == other.h) & (
            F.slice(words, one.p + 1, WINDOW) == F.slice(words, other.p + 1, WINDOW)
        )

    def repeated(one: Column, k: Column) -> Column:
        before, after = F.get(ranked, k - 1), F.get(ranked, k + 1)
        return F.coalesce(same(one, before), F.lit(False)) | F.coalesce(same(one, after), F.lit(False))

    def covered(p: Column, k: Column) -> Column:
        """Words from here to the next start, but not beyond the window."""
        return F.least(F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))

    none = F.expr("CAST(array() AS ARRAY<BIGINT>)")
    unsorted = F.transform(windows, lambda h, p: F.struct(h.alias("h"), p.alias("p")))
    return (
        docs.withColumn("hashes", F.transform(words, lambda w: F.xxhash64(w)))
        .withColumn(
            "windows",
            F.when(
                F.size("hashes") >= WINDOW,
                F.transform(F.sequence(F.lit(0), F.size("hashes") - WINDOW), window),
            ).otherwise(none),
        )
        .withColumn(
            "ranked",
            F.when(
                F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(unsorted)
            ).otherwise(F.expr("CAST(array() AS ARRAY<STRUCT<h: BIGINT, p: INT>>)")),
        )
        .withColumn(
            "starts", F.sort_array(F.transform(F.filter(ranked, repeated), lambda x: x.p))
        )
        .withColumn(
            "n_repeat_words",
            F.aggregate(
                F.transform(starts, covered), F.lit(0).cast("long"), lambda total, n: total + n
            ),
        )
        .drop("hashes", "windows", "ranked", "starts")
    )


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The verdict on every row of ``docs`` (columns doc_id, text and lang).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed (breaks one of BASE_RULES), kept (breaks none of those and none
    of ``rules``), broken_rules (their names, joined by commas, empty if none)
    and the other measures.

    A null or empty text has no words and fails. Null and repeated ids, and
    repeated rows, are rows like any other; a null lang counts as any that the
    rules know. Other columns are ignored, and an empty table gives no rows. A
    text is held whole by one task.
    """
    measured = measure(docs)
    base_failed = F.lit(False)
    for rule in BASE_RULES:
        base_failed = base_failed | breaks(rule)
    broken = F.concat_ws(
        ",", *[F.when(breaks(rule), F.lit(rule.name)) for rule in (*BASE_RULES, *rules)]
    )
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (broken == "").alias("kept"),
        broken.alias("broken_rules"),
        "n_lines",
        "n_exclamations",
        "n_stop_words",
    )
