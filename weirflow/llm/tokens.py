"""Token ids of whole texts by a public tokenizer, fast enough for a corpus."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, pre_tokenizers

from weirflow.llm.shingles import Hasher, text_bytes

VOCABULARY = "word_bpe_49k.json"
# Distinct words and chunks that a task remembers, and bytes of text that it takes
# at a time.
KNOWN_WORDS, KNOWN_CHUNKS, STEP_BYTES = 1_000_000, 200_000, 1_000_000

def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file as text, for tasks: executors need no copy of it."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as file:
        return file.read()


def _byte_letters() -> dict[int, int]:
    """How byte-level vocabularies write bytes: printable ones as themselves,
    the others, in order, as the letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    letters = {b: b for b in printable} | {b: 0x100 + i for i, b in enumerate(others)}
    return letters | {0x20: 0x20}  # between words


# Classes of bytes: white space, letters, digits, others, and not plain. Bytes of
# plain letters beyond ASCII are 0xC3 and one of these.
_SPACE, _LETTER, _DIGIT, _OTHER, _ODD = range(5)
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[0x21:0x7F] = _OTHER
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), 0xC3]] = _LETTER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_AFTER_C3 = np.zeros(256, bool)
_AFTER_C3[0x80:0xC0] = True
_AFTER_C3[[0x97, 0xB7]] = False  # the signs of multiplication and division


class ChunkTokenizer:
    """Ids without special tokens, as little-endian unsigned 32-bit integers.

    Texts of plain characters are split into words as the tokenizer does, over
    the bytes of all texts at once; each distinct word is encoded once while it
    is known, by the merges of the model alone. All other texts go to the
    tokenizer as they are, by the chunks between ASCII white space, at which the
    tokenizer splits anyway.
    """

    def __init__(self, json: str) -> None:
        self._tokenizer = Tokenizer.from_str(json)
        self._merges = Tokenizer.from_str(json)
        self._merges.normalizer = None
        self._merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._letters = _byte_letters()
        self._hasher = Hasher()
        self._chunks: dict[bytes, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        # Known words by ascending hash, and where their ids are.
        self._hashes = np.zeros(0, np.uint64)
        self._starts = self._sizes = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; none for a null or empty one."""
        letters, offsets = text_bytes(texts)
        lower, kinds = self._plain(letters)
        odd = self._odd_texts(lower, kinds, offsets)
        for i in odd:
            kinds[offsets[i] : offsets[i + 1]] = _SPACE
        starts, stops = self._words(lower, kinds, offsets)
        at = self._known(lower, starts, stops)
        sizes = self._sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        source = np.repeat(self._starts[at] - (ends - sizes), sizes) + np.arange(total)
        data = self._ids[source].tobytes()
        edges = 4 * np.concatenate([[0], ends])[np.searchsorted(starts, offsets)]
        out = [data[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        for i in odd:
            out[i] = self._by_chunks(letters[offsets[i] : offsets[i + 1]].tobytes())
        return out

    @staticmethod
    def _plain(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower-case bytes and their classes."""
        lower, kinds = _LOWER[letters], _CLASS[letters]
        lead = np.flatnonzero(letters == 0xC3)
        if len(lead):
            lead = lead[lead + 1 < len(letters)]
            follow = lead + 1
            good = _AFTER_C3[letters[follow]]
            kinds[follow[good]] = _LETTER
            kinds[follow[~good]] = _ODD
            upper = follow[good & (letters[follow] < 0x9F)]
            lower[upper] += 32
        return lower, kinds

    @staticmethod
    def _odd_texts(lower: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> list[int]:
        odd = kinds == _ODD
        if len(lower) > 1:  # may begin a special token
            odd[:-1] |= (lower[:-1] == ord("<")) & (lower[1:] == ord("|"))
        places = np.flatnonzero(odd)
        return np.unique(np.searchsorted(offsets, places, "right") - 1).tolist()

    @staticmethod
    def _words(lower: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words start and stop: runs of letters or of others, and single
        digits. After anything but others an apostrophe and certain letters are
        a word (the vocabulary's split pattern; fixed values)."""
        n = len(lower)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        edge = np.ones(n + 1, bool)
        edge[1:n] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        edge |= first
        marks = np.flatnonzero(lower == ord("'"))
        if len(marks):
            marks = marks[edge[marks] & (kinds[marks] == _OTHER)]
            after = np.full((2, len(marks)), ord(" "), np.uint8)
            for k in (1, 2):  # letters of the same text
                inside = marks + k < n
                at = marks[inside] + k
                after[k - 1, inside] = np.where(first[at], ord(" "), lower[at])
            after[1, after[0] == ord(" ")] = ord(" ")
            pair = after[0].astype(np.int32) << 8 | after[1]
            long = np.isin(pair, [int.from_bytes(x, "big") for x in (b"re", b"ve", b"ll")])
            short = np.isin(after[0], np.frombuffer(b"stmd", np.uint8)) & ~long
            edge[marks[short | long] + 1] = False
            edge[marks[long] + 2] = False
            edge[marks[short] + 2] = True
            edge[marks[long] + 3] = True
        places = np.flatnonzero(edge)
        is_word = kinds[places[:-1]] != _SPACE
        return places[:-1][is_word], places[1:][is_word]

    def _known(self, lower: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The number of every word among the known ones, which new ones join."""
        hashes = self._hasher.spans(lower, starts, stops)
        order = np.argsort(hashes)
        ranked = hashes[order]
        begins = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1]) != 0)
        distinct = ranked[begins]
        if len(self._hashes) + len(distinct) > KNOWN_WORDS:
            self._forget()
        at = np.searchsorted(self._hashes, distinct)
        known = at < len(self._hashes)
        known[known] = self._hashes[at[known]] == distinct[known]
        if not known.all():
            new = order[begins[~known]]
            self._learn(lower, distinct[~known], starts[new], stops[new])
            at = np.searchsorted(self._hashes, distinct)
        out = np.empty(len(hashes), np.int64)
        out[order] = np.repeat(at, np.diff(begins, append=len(hashes)))
        return out

    def _learn(self, lower: np.ndarray, hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> None:
        data = lower.tobytes()
        words = b" ".join([data[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)])
        letters = words.decode("latin-1").translate(self._letters).split(" ")
        found = self._merges.encode(letters, is_pretokenized=True, add_special_tokens=False).ids
        ids = np.array(found, np.uint32)
        # Each word ends with the one token that is marked as an end.
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(hashes):
            raise ValueError("the vocabulary does not mark the ends of words")
        sizes = np.diff(ends, prepend=0)
        merged = np.concatenate([self._hashes, hashes])
        order = np.argsort(merged)
        self._hashes = merged[order]
        self._starts = np.concatenate([self._starts, len(self._ids) + ends - sizes])[order]
        self._sizes = np.concatenate([self._sizes, sizes])[order]
        self._ids = np.concatenate([self._ids, ids])

    def _by_chunks(self, text: bytes) -> bytes:
        known = self._chunks
        if len(known) > KNOWN_CHUNKS:
            known.clear()
        out = []
        for chunk in text.split():
            if chunk not in known:
                ids = self._tokenizer.encode(chunk.decode(), add_special_tokens=False).ids
                known[chunk] = np.array(ids, "<u4").tobytes()
            out.append(known[chunk])
        return b"".join(out)


def worker_tokenizer(json: str) -> ChunkTokenizer:
    """The tokenizer of this Python worker, with the words that it knows from
    earlier tasks. Functions that travel with their tasks have no module of
    their own to keep it in, so it has one in the worker."""
    name = "weirflow_worker_tokenizers"
    kept = sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("kept", {})
    if json not in kept:
        kept[json] = ChunkTokenizer(json)
    return kept[json]


def text_steps(texts: pa.Array) -> Iterator[int]:
    """Numbers of rows, one after another, that hold about STEP_BYTES together."""
    rows = held = 0
    for text in texts:
        rows += 1
        held += len(text.as_buffer()) if text.is_valid else 0
        if held >= STEP_BYTES:
            yield rows
            rows = held = 0
    if rows:
        yield rows
