"""Token ids in binary blocks, by an adaptive context-mixing range coder.

A block stands alone: its model starts empty, and a checksum covers the ids that
it decodes to. It has at most BLOCK_IDS ids; a row of the file holds whole
documents and as many blocks as they need. Inside a block the ids run in up to
LANES lanes side by side, each a contiguous stretch. Step t codes
the t-th id of every lane, all with the model as it is after step t - 1, so that
both directions are array operations over the lanes.

The model mixes three predictions of an id. Order 2 and order 1 name the id that
last followed the two ids, or the one id, before; order 0 is the frequency of
every id so far. The weights of the mix depend on how often the two named ids
came true lately, and adapt to which order would have been right. The mix is one
interval of the range for each id:

    [ order 2's id | order 1's id | order 0: all ids by their frequency ]

All of it is integer arithmetic, equal on every machine.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.tokens import text_steps, tokenizer_json, worker_tokenizer
from weirflow.session import scratch_path

END = 1
BLOCK_IDS, LANES, LANE_IDS = 1 << 20, 4096, 256
MAGIC = b"WFI1"
# Bits of the total of the mix, of order 0's share in it, and of the range.
_WEIGHT_BITS, _FREQUENCY_BITS = 10, 18
_TOTAL_BITS = _WEIGHT_BITS + _FREQUENCY_BITS
_STATE_BITS, _DIGIT_BITS = 63, 32
_DIGIT = np.uint64((1 << _DIGIT_BITS) - 1)
_LOW = np.uint64((1 << (_STATE_BITS - _DIGIT_BITS)) - 1)
_TABLE = 1 << 18
LARGEST = 1 << (_FREQUENCY_BITS - 1)
# How sure an order is next, after missing and after naming the id.
_SURER = np.array([1, 1, 1, 1, 1, 2, 3, 3])
# Magic, documents, coded runs and bytes of the documents' table; and for each
# run ids, alphabet, lanes, bytes and checksum.
_HEAD, _RUN = "<4sIII", "<IIIII"


class _Mix:
    """The adaptive model of one block. Both directions call ``predict`` before
    and ``learn`` after every step, with the same ids."""

    def __init__(self, alphabet: int, lanes: int) -> None:
        self.alphabet = alphabet
        # By the two ids before, and by the one: the id named, and in the two
        # lowest bits how sure it is (0: none was named yet).
        self.table2 = np.zeros(_TABLE, np.int64)
        self.table1 = np.zeros(alphabet + 1, np.int64)
        self.before = np.full(lanes, alphabet, np.int64)
        self.before2 = np.full(lanes, alphabet, np.int64)
        self.counts = np.zeros(alphabet, np.int64)
        self.pending: list[np.ndarray] = []
        self.steps, self.renew = 0, 1
        # How often, by context, order 2, order 1 or only order 0 was right.
        self.wins = np.ones((16, 3), np.int64)
        self._frequencies()
        self._weights()

    def _frequencies(self) -> None:
        """Order 0: every id keeps a frequency of at least 1."""
        if self.pending:
            self.counts += np.bincount(np.concatenate(self.pending), minlength=self.alphabet)
            self.pending = []
        room = (1 << _FREQUENCY_BITS) - self.alphabet
        total = int(self.counts.sum())
        scaled = 1 + (self.counts * room // total if total else 0)
        frequency = np.zeros(self.alphabet, np.int64) + scaled
        frequency[0 if not total else int(self.counts.argmax())] += (1 << _FREQUENCY_BITS) - int(
            frequency.sum()
        )
        ends = np.cumsum(frequency)
        # Start and frequency of an id in one number.
        self.span = ((ends - frequency) << 32 | frequency).astype(np.uint64)
        self.at = np.repeat(np.arange(self.alphabet), frequency)

    def _weights(self) -> None:
        """Weights of 2^_WEIGHT_BITS by context; order 0 always keeps some. An
        order that has not named an id yet has none."""
        total = self.wins.sum(axis=1)
        room = (1 << _WEIGHT_BITS) - 16
        two = self.wins[:, 0] * room // total
        one = self.wins[:, 1] * room // total
        two[:4] = 0
        one[::4] = 0
        shift = np.uint64(_FREQUENCY_BITS)
        self.weight2 = two.astype(np.uint64) << shift
        self.upto1 = (two + one).astype(np.uint64) << shift
        self.weight0 = ((1 << _WEIGHT_BITS) - two - one).astype(np.uint64)

    def predict(self) -> None:
        slot = self.before2 * 0x9E3779B1
        slot += self.before * 0x85EBCA6B
        slot >>= 7
        slot &= _TABLE - 1
        self.slot = slot
        said2, said1 = self.table2.take(slot), self.table1.take(self.before)
        self.trust2, self.trust1 = said2 & 3, said1 & 3
        self.named2, self.named1 = said2 >> 2, said1 >> 2
        self.context = context = self.trust2 << 2 | self.trust1
        self.w2, self.w1, self.w0 = (w.take(context) for w in (self.weight2, self.upto1, self.weight0))

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """``hit2`` and ``hit1``: where order 2 and order 1 name the id."""
        winner = self.context * 3 + 2 - hit1
        winner[hit2] = self.context[hit2] * 3
        self.wins += np.bincount(winner, minlength=48).reshape(-1, 3)
        shifted = ids << 2
        self.table2[self.slot] = shifted | _SURER.take(self.trust2 + 4 * hit2)
        self.table1[self.before] = shifted | _SURER.take(self.trust1 + 4 * hit1)
        self.before2, self.before = self.before, ids
        self.pending.append(ids)
        self.steps += 1
        if self.steps == self.renew:  # often at first, then every 16 steps
            self._weights()
            self._frequencies()
            self.renew += min(self.steps, 16)


def _lanes(n: int) -> tuple[int, int]:
    """Number of lanes, and ids of each (of the last one: the rest)."""
    lanes = max(1, min(LANES, n // LANE_IDS))
    length = -(-n // lanes)
    return -(-n // length), length


def encode_ids(ids: np.ndarray) -> tuple[int, np.ndarray, bytes]:
    """The alphabet, the number of digits of every lane, and their digits."""
    alphabet = int(ids.max()) + 1 if len(ids) else 1
    if alphabet > LARGEST:
        raise ValueError(f"ids above {LARGEST - 1} need more bits for frequencies")
    n = len(ids)
    if not n:
        return alphabet, np.zeros(0, np.uint32), b""
    lanes, length = _lanes(n)
    # By step; lanes past the end of the last one code nothing.
    grid = np.zeros(lanes * length, np.int64)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, length).T)
    short = n - (lanes - 1) * length
    model = _Mix(alphabet, lanes)
    low = np.zeros(lanes, np.uint64)
    width = np.full(lanes, 1 << _STATE_BITS, np.uint64)
    digits = np.zeros((lanes, length + 3), np.uint64)
    used = np.zeros(lanes, np.int64)
    total, floor = np.uint64(_TOTAL_BITS), np.uint64(1 << (_STATE_BITS - _DIGIT_BITS))
    digit_shift, state_shift = np.uint64(_STATE_BITS - _DIGIT_BITS), np.uint64(_DIGIT_BITS)
    for step in range(length):
        if step == short:  # the last lane has ended
            model.before, model.before2 = model.before[:-1], model.before2[:-1]
            ended = low[-1:].copy()
            _flush(digits[-1:], used[-1:], ended)
            low, width = low[:-1], width[:-1]
        row = grid[step, : len(low)]
        model.predict()
        hit2, hit1 = model.named2 == row, model.named1 == row
        hit2 &= model.trust2 > 0
        hit1 &= model.trust1 > 0
        span = model.span.take(row)
        start = model.w1 + (span >> state_shift) * model.w0
        size = (span & _DIGIT) * model.w0
        # Order 1 where it names the id, then order 2, where they have weight.
        coded = np.flatnonzero(hit1 & (model.w1 > model.w2))
        start[coded], size[coded] = model.w2[coded], model.w1[coded] - model.w2[coded]
        coded = np.flatnonzero(hit2 & (model.w2 > 0))
        start[coded], size[coded] = 0, model.w2[coded]
        unit = width >> total
        low += unit * start
        width = unit * size
        small = np.flatnonzero(width < floor)
        if len(small):
            at = low[small]
            digits[small, used[small]] = at >> digit_shift
            used[small] += 1
            low[small] = (at & _LOW) << state_shift
            width[small] <<= state_shift
        model.learn(row, hit2, hit1)
    _flush(digits[: len(low)], used[: len(low)], low)
    # Carries go to the digits before.
    digits = digits[:, : int(used.max())]
    base = np.uint64(_DIGIT_BITS)
    while True:
        carry = digits >> base
        if not carry.any():
            break
        digits &= _DIGIT
        digits[:, :-1] += carry[:, 1:]
    there = np.arange(digits.shape[1]) < used[:, None]
    return alphabet, used.astype("<u4"), digits[there].astype("<u4").tobytes()


def _flush(digits: np.ndarray, used: np.ndarray, low: np.ndarray) -> None:
    rows = np.arange(len(low))
    shift = np.uint64(_STATE_BITS - _DIGIT_BITS)
    digits[rows, used] = low >> shift
    digits[rows, used + 1] = (low & _LOW) << np.uint64(2 * _DIGIT_BITS - _STATE_BITS)
    used += 2


def decode_ids(n: int, alphabet: int, used: np.ndarray, data: bytes) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint32)
    lanes, length = _lanes(n)
    short = n - (lanes - 1) * length
    stream = np.concatenate([np.frombuffer(data, "<u4"), np.zeros(4, np.uint32)]).astype(np.uint64)
    at = np.cumsum(used.astype(np.int64)) - used
    # The first 63 bits of each lane; a digit is pulled in whenever one went out.
    one = np.uint64(2 * _DIGIT_BITS - _STATE_BITS)
    code = stream[at] << np.uint64(_STATE_BITS - _DIGIT_BITS) | stream[at + 1] >> one
    rest = stream[at + 1] & np.uint64((1 << int(one)) - 1)  # bits not yet in the state
    at += 2
    model = _Mix(alphabet, lanes)
    width = np.full(lanes, 1 << _STATE_BITS, np.uint64)
    grid = np.zeros((length, lanes), np.int64)
    total, floor = np.uint64(_TOTAL_BITS), np.uint64(1 << (_STATE_BITS - _DIGIT_BITS))
    state_shift = np.uint64(_DIGIT_BITS)
    top = np.uint64((1 << _TOTAL_BITS) - 1)
    for step in range(length):
        if step == short:
            model.before, model.before2 = model.before[:-1], model.before2[:-1]
            code, width, at, rest = code[:-1], width[:-1], at[:-1], rest[:-1]
        model.predict()
        unit = width >> total
        value = np.minimum(code // unit, top)
        # Below 2^53, so a division of doubles is exact enough to round down.
        inner = np.maximum(value, model.w1) - model.w1
        row = model.at.take((inner.astype(np.float64) / model.w0).astype(np.int64))
        span = model.span.take(row)
        start = model.w1 + (span >> state_shift) * model.w0
        size = (span & _DIGIT) * model.w0
        coded = np.flatnonzero(value < model.w1)
        start[coded], size[coded] = model.w2[coded], model.w1[coded] - model.w2[coded]
        row[coded] = model.named1[coded]
        coded = np.flatnonzero(value < model.w2)
        start[coded], size[coded] = 0, model.w2[coded]
        row[coded] = model.named2[coded]
        code -= unit * start
        width = unit * size
        small = np.flatnonzero(width < floor)
        if len(small):
            pulled = stream[np.minimum(at[small], len(stream) - 1)]
            # The state takes 32 bits: those left over and the next digit's first.
            code[small] = (
                code[small] << state_shift
                | rest[small] << np.uint64(_STATE_BITS - _DIGIT_BITS)
                | pulled >> one
            )
            rest[small] = pulled & np.uint64((1 << int(one)) - 1)
            at[small] += 1
            width[small] <<= state_shift
        grid[step, : len(row)] = row
        hit2, hit1 = model.named2 == row, model.named1 == row
        hit2 &= model.trust2 > 0
        hit1 &= model.trust1 > 0
        model.learn(row, hit2, hit1)
    return grid.T.reshape(-1)[: (lanes - 1) * length + short].astype(np.uint32)


def pack_row(doc_ids: list[int | None], lengths: list[int], ids: bytes) -> bytes:
    """Documents and their ids (as unsigned 32-bit integers) as bytes."""
    table = np.array([[d or 0 for d in doc_ids], lengths, [d is None for d in doc_ids]], "<i8")
    packed = zlib.compress(table.tobytes(), 1)
    step = 4 * BLOCK_IDS
    out = [struct.pack(_HEAD, MAGIC, len(doc_ids), -(-len(ids) // step), len(packed)), packed]
    for start in range(0, len(ids), step):
        part = ids[start : start + step]
        alphabet, used, data = encode_ids(np.frombuffer(part, "<u4"))
        out += [struct.pack(_RUN, len(part) // 4, alphabet, len(used), len(data), zlib.crc32(part))]
        out += [used.tobytes(), data]
    return b"".join(out)


def unpack_row(row: bytes) -> tuple[list[int | None], list[int], bytes]:
    """The opposite of ``pack_row``; raises if a block is damaged."""
    magic, docs, runs, size = struct.unpack_from(_HEAD, row)
    if magic != MAGIC:
        raise ValueError("not a row of token ids")
    at = struct.calcsize(_HEAD)
    table = np.frombuffer(zlib.decompress(row[at : at + size]), "<i8").reshape(3, docs)
    doc_ids = [None if null else d for d, null in zip(table[0].tolist(), table[2].tolist(), strict=True)]
    at += size
    out = []
    for _ in range(runs):
        n, alphabet, lanes, length, checksum = struct.unpack_from(_RUN, row, at)
        at += struct.calcsize(_RUN)
        used = np.frombuffer(row, "<u4", lanes, at)
        at += 4 * lanes
        part = decode_ids(n, alphabet, used, row[at : at + length]).astype("<u4").tobytes()
        at += length
        if zlib.crc32(part) != checksum:
            raise ValueError("a block of token ids does not have its checksum")
        out.append(part)
    return doc_ids, table[1].tolist(), b"".join(out)


def write_ids(docs: DataFrame, path: str, json: str | None = None, end: int = END) -> None:
    """Write the token ids of every row of ``docs`` (doc_id, text), each followed
    by ``end``, in ascending order of doc_id (nulls first), below ``path``.

    The files are Parquet: segment and block, by which rows are in order, the
    numbers of documents and ids, and the coded row.
    """
    json = json or tokenizer_json()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, segment, block = worker_tokenizer(json), TaskContext.get().partitionId(), 0
        tail = end.to_bytes(4, "little")
        doc_ids: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def row():
            lengths = [len(p) // 4 for p in parts]
            return pa.RecordBatch.from_pydict(
                {
                    "segment": pa.array([segment], pa.int32()),
                    "block": pa.array([block], pa.int32()),
                    "n_docs": pa.array([len(parts)], pa.int64()),
                    "n_ids": pa.array([sum(lengths)], pa.int64()),
                    "coded": pa.array([pack_row(doc_ids, lengths, b"".join(parts))], pa.binary()),
                }
            )

        for batch in batches:
            begin = 0
            for size in text_steps(batch.column("text")):
                names = batch.column("doc_id").slice(begin, size).to_pylist()
                texts = batch.column("text").slice(begin, size)
                begin += size
                for name, ids in zip(names, tokenizer.encode(texts), strict=True):
                    doc_ids.append(name)
                    parts.append(ids + tail)
                    held += len(ids) // 4 + 1
                    if held >= BLOCK_IDS:
                        yield row()
                        block += 1
                        doc_ids, parts, held = [], [], 0
        if parts:
            yield row()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    schema = "segment int, block int, n_docs long, n_ids long, coded binary"
    ordered.mapInArrow(encode, schema).write.parquet(path)


def read_ids(files: DataFrame) -> DataFrame:
    """segment, block, nth (document in its row), doc_id, n_tokens and ids (as
    little-endian unsigned 32-bit integers), decoded from the files."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, block, doc_ids, lengths, ids in _rows(batches):
            ends = (4 * np.cumsum(lengths)).tolist()
            parts = [ids[end - 4 * n : end] for end, n in zip(ends, lengths, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "segment": pa.array([segment] * len(parts), pa.int32()),
                    "block": pa.array([block] * len(parts), pa.int32()),
                    "nth": pa.array(range(len(parts)), pa.int64()),
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids": pa.array(parts, pa.binary()),
                }
            )

    schema = "segment int, block int, nth long, doc_id long, n_tokens long, ids binary"
    return files.select("segment", "block", "coded").mapInArrow(decode, schema)


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for i in range(batch.num_rows):
            segment, block = (batch.column(k)[i].as_py() for k in ("segment", "block"))
            yield segment, block, *unpack_row(batch.column("coded")[i].as_py())


def summarise(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of
    every document in the files, from the decoded ids."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, block, doc_ids, lengths, ids in _rows(batches):
            ends = np.cumsum(lengths)
            view = memoryview(ids)
            sums = [zlib.crc32(view[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "segment": pa.array([segment] * len(lengths), pa.int32()),
                    "block": pa.array([block] * len(lengths), pa.int32()),
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "inside": pa.array(ends - np.array(lengths, np.int64), pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
            )

    schema = "segment int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    found = files.select("segment", "block", "coded").mapInArrow(check, schema)
    # Ids before a segment, and before a row in its segment.
    rows = files.select("segment", "block", "n_ids")
    earlier = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    segments = rows.groupBy("segment").agg(F.sum("n_ids").alias("ids"))
    segments = segments.select("segment", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("segment").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.withColumn("ahead", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(segments, "segment")
    bases = bases.select("segment", "block", (F.col("base") + F.col("ahead")).alias("base"))
    return found.join(bases, ["segment", "block"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_documents(docs: DataFrame, json: str | None = None, end: int = END) -> DataFrame:
    """Write the ids of every row of ``docs`` (doc_id, text) to fresh files in the
    shared folder, and describe them from the files, as ``summarise`` does.

    A null or empty text has the end id alone. Null ids come first; repeated ids
    and rows are documents of their own, in any order among themselves. An empty
    table gives files without rows. Other columns are ignored. One row of the
    files, hence at least the longest document, is held by one task.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "token-ids")
    write_ids(docs, path, json, end)
    return summarise(spark.read.parquet(path))
