"""Collocations: frequent phrases whose words keep together, for each language.

Candidates are found level by level. A phrase can only be frequent if the two
phrases one word shorter inside it are, so each pass counts the hashes of those
only that pass this test, against a bitmap of fixed size of what was frequent
before. Bitmap and hashes can only let too much through, so the candidates are
safe. A count names a phrase by the hashes of its first words and of its last one,
from which its text follows, and double-array tries of bounded size are broadcast. A task advances the states of all its positions together, one
word at a time, and counts the accepting states it meets; the sum of all tasks
is the exact number of occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirflow.llm.common import staged
from weirflow.llm.shingles import Hasher, mixed, text_bytes
from weirflow.llm.tokens import text_steps
from weirflow.llm.trie import ROOT, DoubleArrayTrie

LEAST_COUNT, LONGEST, FIRST = 100, 5, 2000
NO_LANG = "und"
# Bits of the bitmap, phrases in a trie, counts that a task holds and bytes that say
# what they count, and rows that it hands over at once. Counts that are handed over
# early are summed in the JVM.
BITS, PART_PHRASES, HELD_COUNTS, HELD_BYTES, ROWS = 1 << 25, 500_000, 500_000, 32_000_000, 1 << 16
# Counts of so many phrases travel together, and of so many of these at once.
CHUNK, CHUNKS = 8192, 64
# Bytes of rows that Spark sends to a task at once: each is held several times.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4_000_000
# Bits of the second code of a word in a trie.
DIGIT = 8

_CHAIN = np.uint64(0xD1342543DE82EF95)
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class _Words:
    """The words of some texts."""

    def __init__(self, texts: pa.Array, hasher: Hasher) -> None:
        self.letters, offsets = text_bytes(texts)
        n = len(self.letters)
        broken = _BREAK[self.letters]
        apart = broken | _SPACE[self.letters]
        firsts = offsets[:-1][np.diff(offsets) > 0]
        fresh = np.ones(n + 1, bool)
        fresh[1:n] = apart[:-1]
        fresh[firsts] = True
        self.starts = np.flatnonzero(fresh[:n] & ~apart)
        over = np.ones(n + 1, bool)
        over[:n] = apart
        over[firsts] = True
        self.stops = np.flatnonzero(over[1:] & ~apart) + 1
        self.text = np.searchsorted(offsets, self.starts, "right") - 1
        # Whether a word and the next one are in one piece of one text.
        piece = np.cumsum(broken)[self.starts]
        self.joined = (piece[1:] == piece[:-1]) & (self.text[1:] == self.text[:-1])
        self.hashes = hasher.spans(self.letters, self.starts, self.stops)

    def phrases(self, langs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1, 2, 3 words and so on: the hash of the phrase from every word on,
        together with its language, and whether it is inside one piece."""
        first = mixed(self.hashes ^ langs[self.text])
        hashes, inside = first, np.ones(len(first), bool)
        for k in range(1, LONGEST + 1):
            yield hashes, inside
            hashes = mixed(hashes[:-1] * _CHAIN + first[k:])
            inside = inside[:-1] & self.joined[k - 1 :]

    def spelled(self, at: np.ndarray) -> pa.Array:
        """Some of the words."""
        sizes = self.stops[at] - self.starts[at]
        ends = np.cumsum(sizes)
        letters = _LOWER[self.letters[np.arange(sizes.sum()) + np.repeat(self.starts[at] - ends + sizes, sizes)]]
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        whole = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        return whole.cast(pa.string())

    def written(self, at: np.ndarray, words: int) -> list[str]:
        """The phrases from some words on, with one space between words."""
        single = self.spelled((at[:, None] + np.arange(words)).ravel()).to_pylist()
        return [" ".join(single[i : i + words]) for i in range(0, len(single), words)]


def _seen(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    word = bitmap[(hashes & np.uint64(len(bitmap) - 1)).astype(np.int64)]
    return (word >> (hashes >> np.uint64(58))) & np.uint64(1) != 0


def _bitmap(phrases: DataFrame) -> np.ndarray:
    """A bitmap of a fixed size with a bit for every phrase hash of ``phrases``."""
    words = BITS // 64
    bit = F.expr("shiftleft(1L, CAST(shiftrightunsigned(phrase, 58) AS INT))")
    rows = (
        phrases.groupBy(F.col("phrase").bitwiseAND(F.lit(words - 1)).alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .toArrow()  # at most ``words`` rows
    )
    bitmap = np.zeros(words, np.uint64)
    bitmap[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return bitmap


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile gets its rows BATCH_BYTES at a time."""
    held = spark.conf.getAll.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if held is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, held)


class _Tally:
    """Counts of phrases by their hash, at most about HELD_COUNTS at a time, with
    columns of about HELD_BYTES that say what each phrase is. All are arrays: a
    Python object for each phrase would take many times their memory."""

    def __init__(self, **kinds: pa.DataType) -> None:
        self.kinds = kinds
        self._drop()

    def _drop(self) -> None:
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.columns = [pa.array([], kind) for kind in self.kinds.values()]
        self._new: list[tuple[np.ndarray, np.ndarray, list[pa.Array]]] = []
        self._size = self._bytes = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray, *columns: pa.Array) -> Iterator[pa.RecordBatch]:
        """Counts some phrases; gives what is counted, if there is too much of it."""
        self._new.append((hashes, counts, list(columns)))
        self._size += len(hashes)
        self._bytes += sum(column.nbytes for column in columns)
        if self._size > max(HELD_COUNTS // 4, len(self.hashes)) or self._bytes > HELD_BYTES:
            self.settle()
            if len(self.hashes) > HELD_COUNTS or sum(column.nbytes for column in self.columns) > HELD_BYTES:
                yield from self.taken()

    def settle(self) -> None:
        parts = [(self.hashes, self.counts, self.columns), *self._new]
        hashes, counts = (np.concatenate([part[i] for part in parts]) for i in range(2))
        order = np.argsort(hashes)
        hashes = hashes[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = hashes[1:] != hashes[:-1]
        at = np.flatnonzero(fresh)
        self.hashes = hashes[at]
        self.counts = np.add.reduceat(counts[order], at) if len(at) else counts
        first = pa.array(order[at])
        self.columns = [pa.concat_arrays(held).take(first) for held in zip(*[part[2] for part in parts], strict=True)]
        self._new, self._size, self._bytes = [], 0, 0

    def taken(self) -> Iterator[pa.RecordBatch]:
        """The columns and n, in batches that are small for the JVM, too."""
        self.settle()
        batch = pa.RecordBatch.from_arrays([*self.columns, pa.array(self.counts)], [*self.kinds, "n"])
        self._drop()
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)
        del batch
        pa.default_memory_pool().release_unused()  # a worker lives on for other tasks


def _steps(batches: Iterator[pa.RecordBatch], hasher: Hasher) -> Iterator[tuple[_Words, pa.RecordBatch]]:
    for batch in batches:
        start = 0
        for rows in text_steps(batch.column("text")):
            step = batch.slice(start, rows)
            start += rows
            yield _Words(step.column("text"), hasher), step


def _langs(step: pa.RecordBatch) -> np.ndarray:
    return step.column("lang_hash").to_numpy().view(np.uint64)


def _words(texts: DataFrame, least: int) -> DataFrame:
    """phrase (its hash), lang, text and n of the frequent words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, tally = Hasher(), _Tally(phrase=pa.int64(), lang=pa.string(), text=pa.string())
        for found, step in _steps(batches, hasher):
            hashes, _ = next(found.phrases(_langs(step)))
            distinct, at, counts = np.unique(hashes, return_index=True, return_counts=True)
            langs = step.column("lang").take(pa.array(found.text[at])).cast(pa.string())
            yield from tally.add(distinct, counts, pa.array(distinct.view(np.int64)), langs, found.spelled(at))
        yield from tally.taken()

    counted = texts.mapInArrow(count, "phrase long, lang string, text string, n long")
    # Grouped by the text itself: the least text of a group would take a sort.
    summed = counted.groupBy("phrase", "lang", "text").agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") >= least)


def _longer(texts: DataFrame, words: int, least: int, before: np.ndarray) -> DataFrame:
    """prefix and last (hashes) and n of the frequent phrases of so many words in
    which both phrases of one word less are marked in ``before``."""
    shared = texts.sparkSession.sparkContext.broadcast(before)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, tally, bitmap = Hasher(), _Tally(prefix=pa.int64(), last=pa.int64()), shared.value
        for found, step in _steps(batches, hasher):
            shorter = single = None
            for k, (hashes, inside) in enumerate(found.phrases(_langs(step)), 1):
                if k == words:
                    break
                single, shorter = hashes if k == 1 else single, hashes
            known = _seen(bitmap, shorter)
            at = np.flatnonzero(inside & known[:-1] & known[1:])
            ends = [pa.array(x.view(np.int64)) for x in (shorter[at], single[at + words - 1])]
            yield from tally.add(hashes[at], np.ones(len(at), np.int64), *ends)
        yield from tally.taken()

    counted = texts.mapInArrow(count, "prefix long, last long, n long")
    return counted.groupBy("prefix", "last").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _named(longer: DataFrame, shorter: DataFrame, words: DataFrame) -> DataFrame:
    """phrase, lang and text of phrases given by their prefix and last word."""
    first = shorter.select(F.col("phrase").alias("prefix"), "lang", F.col("text").alias("start"))
    final = words.select(F.col("phrase").alias("last"), F.col("text").alias("word"))
    rows = longer.join(first, "prefix").join(final, "last")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix, last = (batch.column(c).to_numpy().view(np.uint64) for c in ("prefix", "last"))
            phrase = pa.array(mixed(prefix * _CHAIN + last).view(np.int64))
            columns = [phrase, batch.column("lang"), batch.column("text")]
            yield pa.RecordBatch.from_arrays(columns, ["phrase", "lang", "text"])

    text = F.concat_ws(" ", "start", "word").alias("text")
    return rows.select("prefix", "last", "lang", text).mapInArrow(hashed, "phrase long, lang string, text string")


class _Counter:
    """Counts phrases, given by their lang and their text, by a trie of them.

    A word is two codes in the trie, the words with most phrases first, so that
    the children of a node are never far apart. All is arrays: neither the driver
    nor a task holds a Python object for each phrase."""

    def __init__(self, langs: pa.Array, texts: pa.Array) -> None:
        split = pc.split_pattern(texts, " ")
        sizes, written = pc.list_value_length(split).to_numpy(zero_copy_only=False), split.flatten().dictionary_encode()
        del split
        letters, offsets = text_bytes(written.dictionary)
        hashes = Hasher().spans(letters, offsets[:-1], offsets[1:])
        at = written.indices.to_numpy(zero_copy_only=False)
        numbers = np.empty(len(hashes), np.int32)  # from 1 on
        numbers[np.argsort(-np.bincount(at, minlength=len(hashes)), kind="stable")] = np.arange(1, len(hashes) + 1)
        order = np.argsort(hashes)
        self.words, self.numbers = hashes[order], numbers[order]
        if np.any(self.words[1:] == self.words[:-1]):
            raise RuntimeError("two words share a hash")
        # Where the words of every first bits of a hash begin.
        self.shift = np.uint64(64 - max(1, len(hashes).bit_length()))
        firsts = np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift
        self.heads = np.searchsorted(self.words, firsts).astype(np.int32)
        lang = langs.dictionary_encode()
        self.langs = {name: code for code, name in enumerate(lang.dictionary.to_pylist(), 1)}
        self.size = len(texts)
        codes = numbers[at]
        del written, at, order, letters

        def columns() -> Iterator[np.ndarray]:
            yield lang.indices.to_numpy(zero_copy_only=False) + 1
            starts = np.cumsum(sizes) - sizes
            for k in range(int(sizes.max(initial=0))):
                here = np.flatnonzero(sizes > k)
                for codes_of in (_high, _low):
                    column = np.zeros(len(sizes), np.int32)
                    column[here] = codes_of(codes[starts[here] + k])
                    yield column

        self.trie = DoubleArrayTrie.of_columns(self.size, columns())

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """chunk, places, counts: the occurrences of those of CHUNK phrases that occur,
        and which they are; and lang, n: the words of a language. What a task hands over
        follows its texts, not the number of phrases."""
        hasher, counts = Hasher(), np.zeros(self.size, np.int64)
        totals: dict[str, int] = {}
        met: list[np.ndarray] = []
        for found, step in _steps(batches, hasher):
            langs = step.column("lang").to_pylist()
            for i, n in enumerate(np.bincount(found.text, minlength=len(langs)).tolist()):
                totals[langs[i]] = totals.get(langs[i], 0) + n
            met.extend(self._met(found, langs))
            if sum(map(len, met)) > max(2 * HELD_COUNTS, self.size):
                counts += np.bincount(np.concatenate(met), minlength=self.size)
                met = []
        if met:
            counts += np.bincount(np.concatenate(met), minlength=self.size)
        yield from _shards(counts)
        for lang, n in totals.items():
            yield _rows([None], [None], [None], [lang], [n])

    def _numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of words, 0 where a word is in no phrase."""
        last = len(self.words) - 1
        places = self.heads[hashes >> self.shift]
        behind = np.flatnonzero((places <= last) & (self.words[np.minimum(places, last)] < hashes))
        while len(behind):
            places[behind] += 1
            now = places[behind]
            behind = behind[(now <= last) & (self.words[np.minimum(now, last)] < hashes[behind])]
        places = np.minimum(places, last)
        return np.where(self.words[places] == hashes, self.numbers[places], 0)

    def _met(self, found: _Words, langs: list[str]) -> Iterator[np.ndarray]:
        """The phrases that occur, each as often as it does."""
        if not len(self.words):
            return
        numbers = self._numbers(found.hashes)
        roots = self.trie.step(
            np.full(len(langs), ROOT), np.array([self.langs.get(lang, 0) for lang in langs], np.int64)
        )
        states = roots[found.text]
        at = np.flatnonzero((states >= 0) & (numbers > 0))
        states = states[at]
        for k in range(LONGEST):
            for codes_of in (_high, _low):
                states = self.trie.step(states, codes_of(numbers[at + k]))
                at, states = at[states >= 0], states[states >= 0]
            accepted = self.trie.accepts[states]
            yield accepted[accepted >= 0]
            on = at + k < len(found.joined)
            on[on] = found.joined[at[on] + k]
            at, states = at[on], states[on]


def _high(numbers: np.ndarray) -> np.ndarray:
    return np.where(numbers > 0, (numbers >> DIGIT) + 1, 0)


def _low(numbers: np.ndarray) -> np.ndarray:
    return np.where(numbers > 0, (numbers & ((1 << DIGIT) - 1)) + 1, 0)


_SHARD = "chunk int, places binary, counts binary, lang string, n long"


def _rows(*columns: list) -> pa.RecordBatch:
    types = (pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.int64())
    names = ["chunk", "places", "counts", "lang", "n"]
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, types, strict=True)], names)


def _shards(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The counts that are not 0, in as few bytes as hold the largest of a chunk."""
    for first in range(0, len(counts), CHUNK * CHUNKS):
        chunks, places, held = [], [], []
        for at in range(first, min(len(counts), first + CHUNK * CHUNKS), CHUNK):
            here = np.flatnonzero(counts[at : at + CHUNK])
            if len(here):
                some = counts[at + here]
                width = next(w for w in (1, 2, 4, 8) if int(some.max()) < 1 << 8 * w)
                chunks.append(at // CHUNK)
                places.append(here.astype("<u2").tobytes())
                held.append(some.astype(f"<u{width}").tobytes())
        if chunks:
            yield _rows(chunks, places, held, [None] * len(chunks), [None] * len(chunks))


def _summed(key: tuple, shards: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """place, n: the sum over all shards of the counts in one chunk."""
    total = np.zeros(CHUNK, np.int64)
    for batch in shards:
        for places, counts in zip(batch.column("places").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            here = np.frombuffer(places, "<u2")
            total[here] += np.frombuffer(counts, f"<u{len(counts) // len(here)}").astype(np.int64)
    place = key[0].as_py() * CHUNK + np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[total > 0])], ["place", "n"])


def _counted(texts: DataFrame, phrases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """lang, words, text and n of all ``phrases``, and lang and n of all words."""
    spark = texts.sparkSession
    parts = -(-phrases.count() // PART_PHRASES) or 1
    sums, totals = [], None
    for part in range(parts):
        # A hashed part of them: about PART_PHRASES. Its order numbers them.
        held = phrases.where(F.pmod(F.xxhash64("lang", "text"), F.lit(parts)) == part)
        rows = held.orderBy("lang", "text").select("lang", "words", "text").toArrow()
        langs, written = (rows.column(c).combine_chunks() for c in ("lang", "text"))
        counter = spark.sparkContext.broadcast(_Counter(langs, written))

        def count(batches: Iterator[pa.RecordBatch], counter=counter) -> Iterator[pa.RecordBatch]:
            yield from counter.value(batches)

        shards = staged(texts.mapInArrow(count, _SHARD), "phrase-shards")
        chunks = shards.where("chunk IS NOT NULL").select("chunk", "places", "counts")
        counts = chunks.groupBy("chunk").applyInArrow(_summed, "place long, n long")
        numbered = spark.createDataFrame(rows.append_column("place", pa.array(np.arange(len(rows)))))
        sums.append(staged(numbered.join(counts, "place").drop("place"), "phrase-counts"))
        if totals is None:
            totals = staged(shards.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
        counter.unpersist()
    counted = sums[0]
    for more in sums[1:]:
        counted = counted.unionByName(more)
    return counted, totals


def score(a, n, left, right):
    """floor(1000 * a * n / (left * right)), exact for products of up to 38 digits."""
    a, n, left, right = (c.cast("decimal(19,0)") for c in (a, n, left, right))
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (a * n), left * right)


def frequent_phrases(docs: DataFrame, least: int = LEAST_COUNT) -> tuple[DataFrame, DataFrame]:
    """lang, words, text and n of every phrase of 1 to LONGEST words that occurs
    ``least`` times or more, words only if a longer phrase has them; and lang and n
    of all words."""
    with _small_batches(docs.sparkSession):
        return _frequent_phrases(docs, least)


def _frequent_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    lang = F.coalesce("lang", F.lit(NO_LANG))
    texts = docs.select(
        F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang"), F.xxhash64(lang).alias("lang_hash")
    )
    words = staged(_words(texts, least).select("phrase", "lang", "text"), "phrase-words")
    level, found = words, []
    for size in range(2, LONGEST + 1):
        bitmap = _bitmap(level)
        if not bitmap.any():
            break
        longer = _longer(texts, size, least, bitmap)
        level = staged(_named(longer, level, words), "phrase-level")
        found.append(level.select("lang", F.lit(size).alias("words"), "text"))
    phrases = found[0] if found else words.where("false").select("lang", F.lit(2).alias("words"), "text")
    for more in found[1:]:
        phrases = phrases.unionByName(more)
    single = phrases.where("words = 2").select("lang", F.explode(F.split("text", " ")).alias("text")).distinct()
    phrases = phrases.unionByName(single.select("lang", F.lit(1).alias("words"), "text"))
    counted, totals = _counted(texts, phrases)
    return counted.where(F.col("n") >= least), totals


def collocations(docs: DataFrame, least: int = LEAST_COUNT, first: int = FIRST) -> DataFrame:
    """The best collocations of each language in ``docs`` (columns text and lang).

    A candidate has 2 to LONGEST words and occurs ``least`` times or more. Cut in
    two, it scores its occurrences against those its parts would have by chance;
    the cut with the lowest score counts, the first of those that tie. Candidates
    inside a longer one that is as frequent are dropped.

    Returns lang, rank (from 1, at most ``first``), phrase, a (occurrences), l and r
    (those of the parts), n (words of the language) and score, ordered by score and
    occurrences, both descending, and the phrase.

    A null text is empty, a null lang is ``und``. Repeated rows count like any
    other, other columns are ignored, and an empty table gives no rows. A text is
    held whole by one task. Words are told apart by 64-bit hashes.
    """
    counted, totals = frequent_phrases(docs, least)
    candidates = counted.where("words > 1")
    text = F.split("text", " ")

    def part(start, size):
        return F.array_join(F.slice(text, start, size), " ")

    # One word more keeps the frequency if any number of words more does.
    longer = (
        counted.where("words > 2")
        .select("lang", "n", F.explode(F.array(part(F.lit(1), F.col("words") - 1), part(F.lit(2), F.col("words") - 1))).alias("text"))
        .groupBy("lang", "text")
        .agg(F.max("n").alias("longest_n"))
    )
    left = counted.select("lang", F.col("text").alias("left_text"), F.col("n").alias("l"))
    right = counted.select("lang", F.col("text").alias("right_text"), F.col("n").alias("r"))
    cuts = (
        candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .withColumn("left_text", part(F.lit(1), F.col("k")))
        .withColumn("right_text", part(F.col("k") + 1, F.col("words") - F.col("k")))
        .join(left, ["lang", "left_text"])
        .join(right, ["lang", "right_text"])
        .join(totals.withColumnRenamed("n", "all"), "lang")
        .withColumn("score", score(F.col("n"), F.col("all"), F.col("l"), F.col("r")))
    )
    lowest = cuts.groupBy("lang", "text").agg(
        F.first("n").alias("a"),
        F.first("all").alias("n"),
        F.min(F.struct("score", "k", "l", "r")).alias("cut"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        lowest.join(longer, ["lang", "text"], "left")
        .where("longest_n IS NULL OR longest_n < a")
        .select("lang", F.col("text").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= first)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
