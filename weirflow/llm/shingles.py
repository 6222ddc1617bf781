"""Word shingles of many texts at once, and fast similarity sketches of them.

Words and shingles are 64-bit hashes, computed over the bytes of a whole batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
COORDINATES = 128
# A band of so many equal coordinates makes two sets candidates.
BAND = 4

_ROUND_BITS, _VALUE_BITS = 8, 49
_BASE = 0x9E3779B97F4A7C15 | 1
_random = np.random.default_rng(5)
_LETTER = _random.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PLACE = _random.integers(0, 1 << 63, WORDS + 1, np.uint64) * np.uint64(2) + np.uint64(1)
_SEEDS = _random.integers(0, 1 << 63, 2 * COORDINATES, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (read only), and where each text starts and
    the last one ends."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    start, end = int(offsets[0]), int(offsets[-1])
    if end == start:
        return np.zeros(0, np.uint8), offsets - start
    return np.frombuffer(texts.buffers()[2], np.uint8, end - start, start), offsets - start


class Hasher:
    """Shingle sets of texts; keeps powers of the base between batches."""

    def __init__(self) -> None:
        self._powers = np.ones(1, np.uint64)
        self._inverse = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self._powers) < n:
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("_powers", _BASE), ("_inverse", inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def spans(self, letters: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Hashes of stretches of bytes, wherever they stand."""
        n = len(letters)
        self._reach(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTER[letters] * self._powers[:n], out=sums[1:])
        return mixed((sums[stops] - sums[starts]) * self._inverse[starts])

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The sorted shingle hashes of each text; none for a null one."""
        letters, offsets = text_bytes(texts)
        n = len(letters)
        space = _SPACE[letters]
        # A word starts after a space or where a text starts, and ends likewise.
        text_starts = offsets[:-1][np.diff(offsets) > 0]
        fresh = np.ones(n + 1, bool)
        fresh[1:n] = space[:-1]
        fresh[text_starts] = True
        starts = np.flatnonzero(fresh[:n] & ~space)
        over = np.ones(n + 1, bool)
        over[:n] = space
        over[text_starts] = True
        stops = np.flatnonzero(over[1:] & ~space) + 1
        del space, fresh, over
        words = self.spans(letters, starts, stops)
        first = np.searchsorted(starts, offsets)
        full = max(0, len(words) - WORDS + 1)
        windows = np.zeros(full, np.uint64)
        for k in range(WORDS):
            windows += words[k : k + full] * _PLACE[k]
        windows = mixed(windows)
        for i in range(len(texts)):
            a, b = int(first[i]), int(first[i + 1])
            if b - a >= WORDS:
                yield np.unique(windows[a : b - WORDS + 1])
            elif b > a:
                # Fewer words are one shingle, told apart by their number.
                few = words[a:b] * _PLACE[: b - a]
                number = _PLACE[-1:] * np.full(1, b - a, np.uint64)
                yield mixed(few.sum(keepdims=True, dtype=np.uint64) + number)
            else:
                yield windows[:0]


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Fast similarity sketch: COORDINATES values of a non-empty set, of which
    two sets share about as many as their Jaccard similarity.

    In each of the first rounds every element goes to a bin by its hash, and a
    bin keeps the least value of the first round that reaches it. After as many
    rounds as there are bins, every element goes to bin 0, 1, 2 and so on, so
    that each coordinate is filled. A coordinate is bin, round and value, packed
    so that one sort finds the first round and least value of every bin.
    """
    rounds = 2 * COORDINATES
    # Rounds that fill all bins but in rare cases.
    likely = min(rounds, -(-6 * COORDINATES // len(hashes)))
    for count in (likely, rounds):
        values = mixed(hashes[None, :] ^ _SEEDS[:count, None])
        at = values >> np.uint64(64 - 7)
        if count > COORDINATES:
            at[COORDINATES:] = np.arange(count - COORDINATES, dtype=np.uint64)[:, None]
        packed = (
            at << np.uint64(64 - 7)
            | np.arange(count, dtype=np.uint64)[:, None] << np.uint64(_VALUE_BITS)
            | values & np.uint64((1 << _VALUE_BITS) - 1)
        ).ravel()
        packed.sort()
        bins = packed >> np.uint64(64 - 7)
        first = np.flatnonzero(np.diff(bins, prepend=np.uint64(COORDINATES)))
        if len(first) == COORDINATES:
            return packed[first]
    raise AssertionError("every coordinate is filled after all rounds")


def bands(values: np.ndarray) -> np.ndarray:
    """One hash for each band of a sketch."""
    rows = values.reshape(-1, BAND)
    keys = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        keys = mixed(keys ^ column)
    return keys.astype(np.int64)


def short(values: np.ndarray) -> bytes:
    """The sketch with one byte for each coordinate."""
    return mixed(values).astype(np.uint8).tobytes()
