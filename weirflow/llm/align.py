"""Alignment of two tokenizers over the bytes of the same texts.

Token-byte incidence matrices A and B say which bytes a token covers. The
product A·Bᵀ has one entry for each pair of tokens that overlap. Offsets at
which tokens of both end cut the tokens into groups; the product of the
group incidences links all tokens of a group.

Both tokenizers split at a space after a character that is no white space, so
that what lies between such places is encoded, and aligned, alike wherever it
stands: each distinct stretch is aligned once while it is known to a task.

How many documents hold a pair of ids linked is a fact of all documents. Texts
are read once, in blocks; a block keeps its documents' pairs as a sparse
matrix. Only the distinct pairs of each block travel to be counted, and their
counts come back to the block. Nothing is as large as the vocabulary's pairs.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from weirflow.llm.common import staged
from weirflow.llm.csr import Csr, product, reach
from weirflow.llm.shingles import mixed, text_bytes
from weirflow.llm.tokens import _byte_letters, text_steps

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Stretches that a task remembers, and bytes of text in a block.
KNOWN_STRETCHES, BLOCK_BYTES = 400_000, 8_000_000

_MARK = "▁"  # how pieces write a space
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LETTER = np.random.default_rng(11).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def vocabularies(byte_path: str | None = None, piece_path: str | None = None) -> tuple[str, bytes]:
    """The two tokenizer files, for tasks: executors need no copy of them."""
    import public_tokenizers

    with open(byte_path or public_tokenizers.path(BYTE_VOCABULARY), encoding="utf-8") as file:
        byte_json = file.read()
    with open(piece_path or public_tokenizers.path(PIECE_VOCABULARY), "rb") as file:
        return byte_json, file.read()


class _Tokens:
    """The bytes of every token of a vocabulary."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(tokens), np.uint8)
        self.names = [str(i) for i in range(len(tokens))]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.letters[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(total)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after another, and where each list starts and the last ends."""
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return np.array([i for x in lists for i in x], np.int64), starts


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[starts])


class Aligner:
    """Aligns stretches of text and remembers them."""

    def __init__(self, byte_json: str, piece_model: bytes) -> None:
        self._bytes = Tokenizer.from_str(byte_json)
        self._bytes.encode_special_tokens = True
        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        letters = {ord(chr(c)): b for b, c in _byte_letters().items() if b != 0x20}
        letters[0x120] = 0x20
        vocabulary = json.loads(byte_json)["model"]["vocab"]
        tokens = [b""] * (max(self._bytes.get_vocab().values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(letters[ord(c)] for c in token)
        pieces, n = [], self._pieces.get_piece_size()
        for i in range(n):
            piece = self._pieces.id_to_piece(i)
            is_byte = self._pieces.is_byte(i)
            pieces.append(bytes([int(piece[3:5], 16)]) if is_byte else piece.replace(_MARK, " ").encode())
        self.a, self.b = _Tokens(tokens), _Tokens(pieces)
        # A piece with a space after something else would reach over a cut.
        self._cuts = not any(_MARK in self._pieces.id_to_piece(i).lstrip(_MARK) for i in range(n))
        self._powers = np.ones(1, np.uint64)
        self._inverse = np.ones(1, np.uint64)
        self._forget()

    @property
    def pairs_width(self) -> int:
        return len(self.b.sizes)

    def _forget(self) -> None:
        # Known stretches by ascending hash, each with its number; what is known of
        # each number: whether both tokenizers keep its bytes, its counts, its
        # groups as text and its pairs of ids with the links of each.
        self._hashes, self._numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._whole = np.zeros(0, bool)
        self._counts = np.zeros((0, 5), np.int64)
        self._groups: list[str] = []
        self._first = np.zeros(1, np.int64)
        self._codes = self._links = np.zeros(0, np.int64)

    def _hashed(self, letters: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        n = len(letters)
        if len(self._powers) <= n:
            for name, base in (("_powers", int(_BASE)), ("_inverse", pow(int(_BASE), -1, 1 << 64))):
                steps = np.full(n + 1, np.uint64(base))
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTER[letters] * self._powers[:n], out=sums[1:])
        return mixed((sums[stops] - sums[starts]) * self._inverse[starts])

    def _stretches(self, letters: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where stretches start: at texts, and at a space after a character that
        is surely no white space, unless only spaces follow in the text."""
        n = len(letters)
        begins = np.zeros(n + 1, bool)
        if n and self._cuts:
            space = letters == 0x20
            last = np.zeros(n, bool)  # ASCII, or a letter of two bytes
            last |= (letters > 0x20) & (letters < 0x7F)
            last[1:] |= (letters[1:] >= 0x80) & (letters[1:] < 0xC0) & (letters[:-1] >= 0xC3) & (letters[:-1] < 0xE0)
            begins[1:n] = space[1:] & last[:-1]
            solid = np.flatnonzero(~space)
            at = np.searchsorted(solid, offsets[1:]) - 1
            end = np.where(at >= 0, solid[at] if len(solid) else 0, -1)
            begins[:n] &= np.arange(n) < np.repeat(end, np.diff(offsets))
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(begins[:n])

    def stretch_numbers(self, letters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all stretches, and where each text's begin and the last end."""
        starts = self._stretches(letters, offsets)
        stops = np.append(starts[1:], len(letters)) if len(starts) else starts
        hashes = self._hashed(letters, starts, stops)
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self._hashes) + len(distinct) > KNOWN_STRETCHES:
            self._forget()
        place = np.searchsorted(self._hashes, distinct)
        known = place < len(self._hashes)
        known[known] = self._hashes[place[known]] == distinct[known]
        if not known.all():
            new = at[~known]
            data = letters.tobytes()
            self._learn(
                distinct[~known],
                [data[a:b] for a, b in zip(starts[new].tolist(), stops[new].tolist(), strict=True)],
            )
            place = np.searchsorted(self._hashes, distinct)
        return self._numbers[place][inverse], np.searchsorted(starts, offsets)

    def _learn(self, hashes: np.ndarray, stretches: list[bytes]) -> None:
        merged = np.concatenate([self._hashes, hashes])
        numbers = np.concatenate([self._numbers, len(self._whole) + np.arange(len(hashes))])
        order = np.argsort(merged)
        self._hashes, self._numbers = merged[order], numbers[order]
        whole, counts, groups, first, codes, links = self.align(stretches)
        self._whole = np.concatenate([self._whole, whole])
        self._counts = np.concatenate([self._counts, counts])
        self._groups += groups
        self._first = np.concatenate([self._first, self._first[-1] + first[1:]])
        self._codes = np.concatenate([self._codes, codes])
        self._links = np.concatenate([self._links, links])

    def align(self, stretches: list[bytes]):
        """For each stretch, which begins with a space: whether both tokenizers
        keep its bytes; numbers of A tokens, B tokens, groups, overlap links and
        links inside groups; its groups as text. Then the distinct pairs of ids
        (A id times the size of B plus B id) with their links, and where each
        stretch's pairs begin. Stretches that lose bytes have none of it."""
        n = len(stretches)
        texts = [s.decode() for s in stretches]
        a_lists = [e.ids for e in self._bytes.encode_batch(texts, add_special_tokens=False)]
        b_lists = self._pieces.encode([t[1:] for t in texts], num_threads=1)
        sizes = np.array([len(s) for s in stretches], np.int64)
        whole = np.ones(n, bool)
        for tokens, lists in ((self.a, a_lists), (self.b, b_lists)):
            ids, starts = _flat(lists)
            whole &= _sums(tokens.sizes[ids], starts) == sizes
        for tokens, lists in ((self.a, a_lists), (self.b, b_lists)):
            kept = np.flatnonzero(whole)
            ids, _ = _flat([lists[i] for i in kept])
            data = np.frombuffer(b"".join([stretches[i] for i in kept]), np.uint8)
            wrong = np.concatenate([[0], np.cumsum(tokens.joined(ids) != data)])
            edges = np.concatenate([[0], np.cumsum(sizes[kept])])
            whole[kept] = np.diff(wrong[edges]) == 0
        nothing: list[int] = []
        a, a_starts = _flat([x if w else nothing for x, w in zip(a_lists, whole, strict=True)])
        b, b_starts = _flat([x if w else nothing for x, w in zip(b_lists, whole, strict=True)])
        a_ends, b_ends = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        n_bytes = int(a_ends[-1]) if len(a_ends) else 0
        edge = np.zeros(1, np.int64)
        of_a = Csr(np.concatenate([edge, a_ends]), np.arange(n_bytes), n_bytes)
        of_b = Csr(np.concatenate([edge, b_ends]), np.arange(n_bytes), n_bytes)
        rows, columns, _ = product(of_a, of_b.transposed())
        # A stretch ends a token of both, so that no group reaches over two.
        shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_group, b_group = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
        in_a = Csr(np.arange(len(a) + 1), a_group, len(shared))
        in_b = Csr(np.arange(len(b) + 1), b_group, len(shared))
        together = reach(in_a, in_b.transposed())
        per_token = np.bincount(rows, minlength=len(a))
        last = np.zeros(len(a), np.int64)
        last[np.diff(a_group, append=len(shared)) > 0] = 1
        counts = np.stack(
            [
                np.diff(a_starts),
                np.diff(b_starts),
                _sums(last, a_starts),
                _sums(per_token, a_starts),
                _sums(together, a_starts),
            ],
            axis=1,
        )
        stretch = np.repeat(np.arange(n), np.diff(a_starts))[rows]
        code = a[rows] * self.pairs_width + b[columns]
        order = np.lexsort((code, stretch))
        stretch, code = stretch[order], code[order]
        fresh = np.ones(len(code), bool)
        fresh[1:] = (stretch[1:] != stretch[:-1]) | (code[1:] != code[:-1])
        at = np.flatnonzero(fresh)
        first = np.searchsorted(stretch[at], np.arange(n + 1))
        groups = self._written(a, b, a_group, b_group, a_starts)
        return whole, counts, groups, first, code[at], np.diff(at, append=len(code))

    def _written(self, a, b, a_group, b_group, a_starts) -> list[str]:
        """The groups of each stretch: ids of A, a bar, ids of B; semicolons between."""
        names_a, names_b = self.a.names, self.b.names
        a_names = [names_a[i] for i in a.tolist()]
        b_names = [names_b[i] for i in b.tolist()]
        edges = np.arange((int(a_group[-1]) + 1 if len(a_group) else 0) + 1)
        a_at = np.searchsorted(a_group, edges).tolist()
        b_at = np.searchsorted(b_group, edges).tolist()
        written = [
            ",".join(a_names[i:j]) + "|" + ",".join(b_names[k:m])
            for i, j, k, m in zip(a_at[:-1], a_at[1:], b_at[:-1], b_at[1:], strict=True)
        ]
        # The group of the first token from each stretch on.
        group = np.append(a_group, len(written))[a_starts].tolist()
        return [";".join(written[i:j]) for i, j in zip(group[:-1], group[1:], strict=True)]

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: whole counts, digest of its groups; where its pairs begin, and
        all pairs with their links, in ascending order inside a text."""
        space, empty = (pa.scalar(s, pa.large_string()) for s in (" ", ""))
        filled = pc.fill_null(texts.cast(pa.large_string()), empty)
        spaced = pc.binary_join_element_wise(space, filled, empty)
        spaced = pc.if_else(pc.equal(filled, empty), empty, spaced)
        letters, offsets = text_bytes(spaced)
        numbers, first = self.stretch_numbers(letters, offsets)
        n = len(texts)
        ends = np.concatenate([[0], np.cumsum(~self._whole[numbers])])
        whole = (np.diff(ends[first]) == 0) & (np.diff(first) > 0)
        kept = np.repeat(whole, np.diff(first))
        counts = np.stack([_sums(column * kept, first) for column in self._counts[numbers].T], axis=1)
        names, listed = self._groups, numbers.tolist()
        digests = [
            hashlib.sha256(";".join([names[i] for i in listed[x:y]]).encode()).hexdigest() if w else ""
            for x, y, w in zip(first[:-1].tolist(), first[1:].tolist(), whole.tolist(), strict=True)
        ]
        doc = np.repeat(np.arange(n), np.diff(first))[kept]
        width = len(self._whole)
        each, times = np.unique(doc * width + numbers[kept], return_counts=True)
        doc, number = each // width, each % width
        sizes = np.diff(self._first)[number]
        ends = np.cumsum(sizes)
        source = np.repeat(self._first[number] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        codes, links = self._codes[source], self._links[source] * np.repeat(times, sizes)
        keys = np.repeat(doc, sizes) * (len(self.a.sizes) * self.pairs_width) + codes
        order = np.argsort(keys)
        keys, links = keys[order], links[order]
        at = np.flatnonzero(np.diff(keys, prepend=-1))
        total = np.add.reduceat(links, at) if len(at) else links
        doc, codes = np.divmod(keys[at], len(self.a.sizes) * self.pairs_width)
        return counts, digests, np.searchsorted(doc, np.arange(n + 1)), codes, total


def worker_aligner(byte_json: str, piece_model: bytes) -> Aligner:
    """The aligner of this Python worker, with what it knows from earlier tasks."""
    name = "weirflow_worker_aligners"
    kept = sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("kept", {})
    key = (byte_json, piece_model)
    if key not in kept:
        kept[key] = Aligner(*key)
    return kept[key]


_COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<u4").tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), "<u4").astype(np.int64)


def _block(number: int, parts: list) -> dict[str, list]:
    """One row for a block of documents: facts of each, and which pairs of the
    block each holds how often, as a sparse matrix."""
    ids, counts, digests, first, codes, links = zip(*parts, strict=True)
    all_codes = np.concatenate(codes)
    distinct, at = np.unique(all_codes, return_inverse=True)
    held = np.concatenate([np.diff(f) for f in first])
    facts = np.concatenate(counts)
    return {
        "block": [number],
        "ids": [[i for part in ids for i in part]],
        **{name: [facts[:, k].tolist()] for k, name in enumerate(_COUNTS)},
        "digests": [[d for part in digests for d in part]],
        "held": [held.tolist()],
        "at": [_pack(at)],
        "links": [_pack(np.concatenate(links))],
        "codes": [distinct],
        "n_docs": [np.bincount(at, minlength=len(distinct))],
    }


def align_documents(docs: DataFrame, files: tuple[str, bytes] | None = None) -> DataFrame:
    """How the tokens of the two vocabularies lie over each text of ``docs``
    (columns doc_id and text).

    Returns doc_id, n_a, n_b (tokens), n_groups, n_links (pairs of tokens that
    overlap), n_best (links of which the pair of ids is in as many documents as
    any of its A id), count_sum (the sum over all links of the documents that
    hold their pair), groups_sha256 and n_group_links (pairs of tokens in the
    same group).

    A null or empty text, and one of which a tokenizer does not give back all
    bytes, has no tokens: zeros and an empty digest. Every row counts as one
    document, also with a null or repeated id; other columns are ignored, and an
    empty table gives no rows. Texts are whole; one is held by one task.
    """
    byte_json, piece_model = files or vocabularies()
    id_field = T.StructField("id", docs.schema["doc_id"].dataType)
    longs = T.ArrayType(T.LongType())
    blocks_schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", T.ArrayType(id_field.dataType)),
            *[T.StructField(name, longs) for name in _COUNTS],
            T.StructField("digests", T.ArrayType(T.StringType())),
            T.StructField("held", longs),
            T.StructField("at", T.BinaryType()),
            T.StructField("links", T.BinaryType()),
            T.StructField("codes", longs),
            T.StructField("n_docs", longs),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_aligner(byte_json, piece_model)
        number = TaskContext.get().partitionId() << 32
        parts, size, arrow = [], 0, None

        def row() -> pa.RecordBatch:
            data = _block(number, parts)
            types_ = [pa.list_(arrow) if name == "ids" else None for name in data]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(data.values(), types_, strict=True)], list(data)
            )

        for batch in batches:
            start, arrow = 0, batch.column("doc_id").type
            for rows in text_steps(batch.column("text")):
                step = batch.slice(start, rows)
                start += rows
                parts.append((step.column("doc_id").to_pylist(), *aligner.documents(step.column("text"))))
                size += step.column("text").nbytes
                if size >= BLOCK_BYTES:
                    yield row()
                    number, parts, size = number + 1, [], 0
        if parts:
            yield row()

    blocks = staged(docs.select("doc_id", "text").mapInArrow(read, blocks_schema), "align-blocks")
    pairs = blocks.select("block", F.explode(F.arrays_zip("codes", "n_docs")).alias("p")).select(
        "block", F.col("p.codes").alias("code"), F.col("p.n_docs").alias("n_docs")
    )
    width = sentencepiece.SentencePieceProcessor(model_proto=piece_model).get_piece_size()
    counted = pairs.groupBy("code").agg(F.sum("n_docs").alias("total"))
    # At most as many rows of one A id as B has ids.
    of_a = Window.partitionBy(F.expr(f"code DIV {width}"))
    counted = counted.withColumn("best", F.col("total") == F.max("total").over(of_a))
    back = pairs.select(F.col("block").alias("of"), "code").join(counted, "code")

    out_schema = T.StructType(
        [
            T.StructField("doc_id", id_field.dataType),
            *[T.StructField(n, T.LongType()) for n in [*_COUNTS[:4], "n_best", "count_sum"]],
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("n_group_links", T.LongType()),
        ]
    )

    def finish(block: pa.Table, counts: pa.Table) -> pa.Table:
        row = block.slice(0, 1)
        values = {name: row.column(name)[0].values for name in ("ids", "digests", "held", "codes", *_COUNTS)}
        codes = values["codes"].to_numpy(zero_copy_only=False)
        total, best = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        place = np.searchsorted(codes, counts.column("code").to_numpy())
        total[place] = counts.column("total").to_numpy()
        best[place] = counts.column("best").to_numpy()
        first = np.concatenate([[0], np.cumsum(values["held"].to_numpy(zero_copy_only=False))])
        n = int(first[-1])
        at, links = (_unpack(row.column(c)[0].as_py(), n) for c in ("at", "links"))
        sums = {"n_best": _sums(best[at] * links, first), "count_sum": _sums(total[at] * links, first)}
        columns = {
            "doc_id": values["ids"],
            **{name: values[name] for name in _COUNTS[:4]},
            **{name: pa.array(v, pa.int64()) for name, v in sums.items()},
            "groups_sha256": values["digests"],
            "n_group_links": values["n_group_links"],
        }
        return pa.table(columns)

    whole = blocks.drop("n_docs")
    return whole.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(finish, out_schema)
