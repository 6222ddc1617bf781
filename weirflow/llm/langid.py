"""Language identification by segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary. The
probability of a word is the sum over all its segmentations into pieces, which
a forward pass over its letters gives; that of a text is the product over its
words. The distributions are fitted by expectation maximisation on a bounded
sample of labelled documents. Only the model, of a fixed size per language,
passes through the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.llm.tokens import text_steps

UNKNOWN = "und"
# The sample: so many documents of each language, so many characters of each.
SAMPLE_DOCS, SAMPLE_CHARS = 192, 4_096
# Parts that each find their first ids of a language before one task does.
SAMPLE_PARTS = 32
ROUNDS = 4
# Runs of more letters count as several words.
WORD_LETTERS = 40
START = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
# A letter outside the vocabulary, and the least probability of a piece.
OTHER, LEAST = 1e-7, 1e-9
# Keeps products over a word within the range of a double.
PER_LETTER = 64.0
# Distinct words that a task remembers.
KNOWN_WORDS = 250_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Model(NamedTuple):
    languages: list[str]
    pieces: list[str]
    logs: np.ndarray  # of piece probabilities, pieces by languages


def vocabulary(path: str | None = None) -> list[str]:
    """The pieces of a sentencepiece model, lower-cased; a piece that begins a
    word begins with START."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()))
    return sorted({t for t in texts if t and t.removeprefix(START).isalpha()})


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


class Lattice:
    """All pieces at all places of many words, found level by level: a place
    stays in the search as long as some piece begins with what it has read."""

    def __init__(self, pieces: list[str]) -> None:
        self.pieces = len(pieces)
        known: dict[str, int] = {p[:n]: -1 for p in pieces for n in range(1, len(p) + 1)}
        known |= {p: i for i, p in enumerate(pieces)}
        width = max(map(len, known))
        chars = np.array(list(known), f"U{width}").view(np.uint32).reshape(len(known), width)
        hashes = np.zeros(len(known), np.uint64)
        for column in chars.T.astype(np.uint64):
            hashes = np.where(column > 0, (hashes + column) * _MULTIPLIER, hashes)
        order = np.argsort(hashes)
        self._hashes = hashes[order]
        self._ids = np.fromiter(known.values(), np.int64)[order]

    def arcs(self, words: list[str]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """Words of one length: for every start and length of a piece the rows
        that have it there and its id, starts ascending. Letters that no piece
        covers have the id ``pieces``."""
        width = len(words[0]) + 1
        chars = np.array([START + w for w in words], f"U{width}").view(np.uint32)
        chars = chars.reshape(len(words), width).astype(np.uint64)
        found = []
        for start in range(width):
            rows = np.arange(len(words))
            hashes = np.zeros(len(words), np.uint64)
            single = np.zeros(len(words), bool)
            for length in range(1, width - start + 1):
                hashes = (hashes + chars[rows, start + length - 1]) * _MULTIPLIER
                at = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
                there = self._hashes[at] == hashes
                ids = self._ids[at]
                is_piece = there & (ids >= 0)
                if is_piece.any():
                    found.append((start, length, rows[is_piece], ids[is_piece]))
                    if length == 1:
                        single[rows[is_piece]] = True
                rows, hashes = rows[there], hashes[there]
                if not len(rows):
                    break
            other = np.flatnonzero(~single)
            if len(other):
                found.append((start, 1, other, np.full(len(other), self.pieces)))
        return found


def _by_length(words: Iterable[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    groups: dict[int, tuple[list[str], list[int]]] = {}
    for i, word in enumerate(words):
        group = groups.setdefault(len(word), ([], []))
        group[0].append(word)
        group[1].append(i)
    for group in groups.values():
        yield group[0], np.array(group[1])


def _forward(width: int, rows: int, arcs, table: np.ndarray) -> np.ndarray:
    """alpha[end, row, language]; ``table`` has PER_LETTER to the length in it."""
    alpha = np.zeros((width + 1, rows, table.shape[1]))
    alpha[0] = 1
    for start, length, at, ids in arcs:
        alpha[start + length, at] += alpha[start, at] * table[ids]
    return alpha


def _scaled(probabilities: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """With a last row for other letters."""
    rows = np.vstack([probabilities, np.full((1, probabilities.shape[1]), OTHER)])
    return rows * PER_LETTER ** lengths[:, None]


def _lengths(pieces: list[str]) -> np.ndarray:
    return np.array([*map(len, pieces), 1], np.float64)


def fit(counts: dict[str, Counter[str]], pieces: list[str], rounds: int = ROUNDS) -> Model:
    """Piece probabilities of each language from counts of its words."""
    languages = sorted(counts)
    words = sorted(set().union(*counts.values())) if counts else []
    seen = np.array([[counts[lang][w] for lang in languages] for w in words], np.float64)
    lattice, lengths = Lattice(pieces), _lengths(pieces)
    groups = []
    for texts, at in _by_length(words):
        groups.append((len(texts[0]) + 1, seen[at], lattice.arcs(texts)))
    expected = np.zeros((len(pieces) + 1, len(languages)))
    for _, n, arcs in groups:  # first every piece that occurs, anywhere
        for _, _, rows, ids in arcs:
            np.add.at(expected, ids, n[rows])
    probabilities = _normalised(expected[:-1])
    for _ in range(rounds):
        table = _scaled(probabilities, lengths)
        expected[:] = 0
        for width, n, arcs in groups:
            alpha = _forward(width, len(n), arcs, table)
            beta = np.zeros_like(alpha)
            beta[width] = n / np.maximum(alpha[width], 1e-300)
            for start, length, rows, ids in reversed(arcs):
                flow = table[ids] * beta[start + length, rows]
                beta[start, rows] += flow
                np.add.at(expected, ids, alpha[start, rows] * flow)
        probabilities = _normalised(expected[:-1])
    return Model(languages, pieces, np.log(probabilities))


def _normalised(expected: np.ndarray) -> np.ndarray:
    shares = expected / np.maximum(expected.sum(axis=0), 1e-300)
    return np.maximum(shares, LEAST)


class Scorer:
    """Log-likelihoods of texts. Words are scored once while they are known."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._lattice = Lattice(model.pieces)
        self._table = _scaled(np.exp(model.logs), _lengths(model.pieces))
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._logs = np.zeros((0, len(self.model.languages)))
        self._is_word = np.zeros(0, bool)

    def _learn(self, words: list[str]) -> None:
        logs = np.zeros((len(words), len(self.model.languages)))
        is_word = np.array([any(c.isalpha() for c in w) for w in words], bool)
        parts = [
            (i, w[k : k + WORD_LETTERS])
            for i, w in enumerate(words)
            if is_word[i]
            for k in range(0, len(w), WORD_LETTERS)
        ]
        owner = np.array([i for i, _ in parts], np.int64)
        for texts, at in _by_length(w for _, w in parts):
            width = len(texts[0]) + 1
            alpha = _forward(width, len(texts), self._lattice.arcs(texts), self._table)
            found = np.log(np.maximum(alpha[width], 1e-300)) - width * np.log(PER_LETTER)
            np.add.at(logs, owner[at], found)
        start = len(self._known)
        self._known.update(zip(words, range(start, start + len(words)), strict=True))
        self._logs = np.concatenate([self._logs, logs])
        self._is_word = np.concatenate([self._is_word, is_word])

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood by language, and the number of words, of each text."""
        found = [words_of(t) if t else [] for t in texts]
        new = set().union(*found).difference(self._known) if found else set()
        if len(self._known) + len(new) > KNOWN_WORDS and self._known:
            self._forget()
            new = set().union(*found)
        if new:
            self._learn(list(new))
        ends = np.cumsum([len(f) for f in found])
        rows = np.fromiter((self._known[w] for f in found for w in f), np.int64, int(ends[-1]) if found else 0)
        logs = np.zeros((len(texts), len(self.model.languages)))
        words = np.zeros(len(texts), np.int64)
        filled = [i for i, f in enumerate(found) if f]
        if filled:
            starts = np.array([ends[i] - len(found[i]) for i in filled])
            logs[filled] = np.add.reduceat(self._logs[rows], starts)
            words[filled] = np.add.reduceat(self._is_word[rows].astype(np.int64), starts)
        return logs, words


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of the sample; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, pieces: list[str] | None = None) -> Model:
    """Fit a model on ``docs`` (doc_id, text, lang): on at most SAMPLE_DOCS
    documents of each language that are not held out, those of the smallest
    hashes of their ids, with their first SAMPLE_CHARS characters. Rows that share
    an id and a language count as one document, that of the smallest text."""
    labelled = docs.where(
        F.col("lang").isNotNull()
        & (F.col("lang") != UNKNOWN)
        & F.col("doc_id").isNotNull()
        & F.col("text").isNotNull()
        & ~held_out(F.col("doc_id"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = labelled.select("doc_id", "lang").distinct()
    # The first ids of each part, then those of all parts: a language is never
    # cut by one task that hears from every other.
    part = F.pmod(F.spark_partition_id(), F.lit(SAMPLE_PARTS)).alias("part")
    chosen = ids.select("doc_id", "lang", part)
    for keys in (["lang", "part"], ["lang"]):
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        chosen = chosen.withColumn("nth", nth).where(F.col("nth") <= SAMPLE_DOCS).drop("nth")
    chosen = chosen.select("doc_id", "lang")
    # At most SAMPLE_DOCS ids of a language.
    sample = (
        labelled.join(F.broadcast(chosen), ["doc_id", "lang"])
        .groupBy("lang", "doc_id")
        .agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text"))
    )
    counts: dict[str, Counter[str]] = {}
    for row in sample.toLocalIterator():
        words = (w[k : k + WORD_LETTERS] for w in words_of(row["text"]) for k in range(0, len(w), WORD_LETTERS))
        counts.setdefault(row["lang"], Counter()).update(words)
    return fit(counts, vocabulary() if pieces is None else pieces)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score, its posterior probability among the
    model's languages, from the column text alone.

    A text that is null or has no letter is ``und`` with score 0, as is every
    text if the model has no language. Ties go to the first language by code
    point. Texts count whole. All columns of ``docs`` are kept; earlier ones of
    the two names are replaced. Nulls elsewhere, repeated rows and empty tables
    need no special care.
    """
    kept = docs.drop("lang_pred", "score")
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*kept.schema.fields, *fields])
    names = schema.names

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            start = 0
            for size in text_steps(batch.column("text")):
                part = batch.slice(start, size)
                start += size
                logs, words = scorer.scores(part.column("text").to_pylist())
                langs, scores = [UNKNOWN] * size, np.zeros(size)
                if model.languages:
                    best = logs.argmax(axis=1)
                    posterior = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                    scores = np.where(words > 0, posterior, 0.0)
                    langs = [model.languages[b] if w else UNKNOWN for b, w in zip(best, words, strict=True)]
                columns = [*part.columns, pa.array(langs, pa.string()), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return kept.mapInArrow(predict, schema)
