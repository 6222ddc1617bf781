"""Packing documents into sequences by a grouping genetic algorithm.

Documents become pieces of at most CAPACITY tokens: full ones are sequences of
their own, the rests are packed. The rests are dealt into groups of about
GROUP_ITEMS; a group is one packing problem, worked on by several islands. An
island evolves a population of packings. Crossover injects well-filled bins of
one packing whole into another, removes the bins there that hold a document
twice, and puts the displaced documents back by best fit, longest first. Then
the best packing of each island migrates to the next one, and the islands go on.
A group stops as soon as it meets a lower bound of the number of bins.

No group can use the room that another one leaves. So each hands its SPARE_BINS
emptiest bins on, and these form groups of a second round, in which the packing
that they come with is the first elite: a group never gets more bins by it.

A group is a row of a table, so islands are tasks like any other; only the
elites travel between them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.llm.common import staged
from weirflow.llm.tokens import text_steps, tokenizer_json, worker_tokenizer

CAPACITY, END = 2048, 0
GROUP_ITEMS = 8192
ISLANDS, EPOCHS = 2, 2
# Crossovers of a full group in one epoch; a small one has more, for the same work.
POPULATION, CROSSOVERS, MOST_CROSSOVERS = 5, 16, 512
SPARE_BINS = 64
SEED = 7


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing has fewer bins: by the sum, and for each limit by the items
    that cannot share a bin with one another and the sum of what is left over."""
    order = np.sort(lengths)
    sums = np.concatenate([[0], np.cumsum(order)])
    best = -(-int(sums[-1]) // capacity)
    for limit in range(0, capacity // 2 + 1, 16):
        alone = len(order) - np.searchsorted(order, capacity - limit, "right")
        low = np.searchsorted(order, capacity // 2, "right")
        high = len(order) - alone
        # Items above half the capacity, each in a bin of its own.
        halves = high - low
        room = halves * capacity - int(sums[high] - sums[low])
        first = np.searchsorted(order, max(limit, 1), "left")
        small = int(sums[low] - sums[min(first, low)])
        best = max(best, alone + halves + max(0, -(-(small - room) // capacity)))
    return int(best)


class _Bins:
    """Bins by their free room, to find the fullest that still takes an item."""

    def __init__(self, capacity: int) -> None:
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, number: int, room: int) -> None:
        self.by_room[room].append(number)
        self.mask |= 1 << room

    def take(self, length: int) -> tuple[int, int] | None:
        """The bin with the least room of at least ``length``, and that room."""
        above = self.mask >> length
        if not above:
            return None
        room = length + (above & -above).bit_length() - 1
        bins = self.by_room[room]
        number = bins.pop()
        if not bins:
            self.mask &= ~(1 << room)
        return number, room


def best_fit(lengths: list[int], items: list[int], bins: np.ndarray, fills: list[int], capacity: int) -> None:
    """Put ``items`` in their order into the bins of ``fills``, which grow as
    needed; ``bins`` gets their numbers."""
    free = _Bins(capacity)
    for number, fill in enumerate(fills):
        if fill < capacity:
            free.add(number, capacity - fill)
    for item in items:
        length = lengths[item]
        found = free.take(length)
        number, room = found or (len(fills), capacity)
        if found is None:
            fills.append(0)
        fills[number] += length
        bins[item] = number
        if room > length:
            free.add(number, room - length)


def _fitness(fills: np.ndarray, capacity: int) -> tuple[int, float]:
    """Larger is better: fewer bins, then more uneven filling."""
    return -len(fills), float(((fills / capacity) ** 2).sum())


class Island:
    """A population of packings of one group. A packing is the number of each
    item's bin; bins are numbered without gaps."""

    def __init__(self, lengths: np.ndarray, seed: int, capacity: int = CAPACITY) -> None:
        self.array, self.lengths, self.capacity = lengths, lengths.tolist(), capacity
        self.random = np.random.default_rng(seed)
        self.bound = lower_bound(lengths, capacity)
        self.people: list[tuple[tuple[int, float], np.ndarray]] = []

    def _join(self, bins: np.ndarray) -> None:
        fills = np.bincount(bins, self.array).astype(np.int64)
        self.people.append((_fitness(fills, self.capacity), bins))

    def _sown(self, noise: float) -> None:
        keys = self.array * (1 + noise * self.random.standard_normal(len(self.array)))
        bins = np.zeros(len(self.array), np.int64)
        best_fit(self.lengths, np.argsort(-keys, kind="stable").tolist(), bins, [], self.capacity)
        self._join(bins)

    @property
    def best(self) -> tuple[tuple[int, float], np.ndarray]:
        return max(self.people, key=lambda person: person[0])

    def done(self) -> bool:
        return bool(self.people) and -self.best[0][0] <= self.bound

    def evolve(self, elites: list[np.ndarray]) -> np.ndarray:
        for bins in elites:
            self._join(bins)
        if len(self.people) < 2 and not self.done():
            self._sown(0.0)
        while len(self.people) < POPULATION and not self.done():
            self._sown(0.02 * len(self.people))
        for _ in range(min(MOST_CROSSOVERS, CROSSOVERS * max(1, GROUP_ITEMS // len(self.array)))):
            if self.done():
                break
            self._join(self._child())
            # Packings as good as one another are often the same one.
            if sum(person[0] == self.people[-1][0] for person in self.people) > 1:
                del self.people[-1]
                continue
            worst = min(range(len(self.people)), key=lambda i: self.people[i][0])
            del self.people[worst]
        return self.best[1]

    def _child(self) -> np.ndarray:
        order = sorted(self.people, key=lambda person: person[0])
        a = order[-1][1] if self.random.random() < 0.5 else order[self.random.integers(len(order))][1]
        others = [person[1] for person in order if person[1] is not a] or [a]
        return self.crossover(a, others[self.random.integers(len(others))])

    def crossover(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``a`` with some of the well-filled bins of ``b``."""
        fills = np.bincount(b, self.array)
        full = np.flatnonzero(fills >= np.quantile(fills, 0.5))
        share = self.random.uniform(0.05, 0.3)
        chosen = self.random.random(len(full)) < share
        chosen[self.random.integers(len(full))] = True
        injected = full[chosen]
        comes = np.isin(b, injected)
        hit = np.zeros(a.max() + 1, bool)
        hit[a[comes]] = True
        # The emptiest bins are given up as well, for their items to fit better.
        own = np.bincount(a, self.array)
        hit |= own < np.quantile(own, 0.05)
        hit[self.random.integers(len(hit), size=self.random.integers(1, 4))] = True
        stays = ~hit[a] & ~comes
        child = np.full(len(a), -1, np.int64)
        _, kept = np.unique(a[stays], return_inverse=True)
        child[stays] = kept
        first = kept.max() + 1 if len(kept) else 0
        _, new = np.unique(b[comes], return_inverse=True)
        child[comes] = first + new
        placed = stays | comes
        filled = np.bincount(child[placed], self.array[placed]).astype(np.int64).tolist()
        loose = np.flatnonzero(~placed)
        keys = self.array[loose] * (1 + self.random.choice([0.0, 0.1, 0.3, 1.0]) * self.random.standard_normal(len(loose)))
        loose = loose[np.argsort(-keys, kind="stable")]
        best_fit(self.lengths, loose.tolist(), child, filled, self.capacity)
        return child


_PIECES = "piece int, start long, length long, ids_crc32 long, unit int, item long"


def cut_pieces(docs: DataFrame, json: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The pieces of every row of ``docs`` (doc_id, text), staged: doc_id, piece,
    start, length, ids_crc32, and the place of the piece in the table (unit,
    item), which tells even equal rows apart."""
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(_PIECES).fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, unit, item = worker_tokenizer(json), TaskContext.get().partitionId(), 0
        tail = end.to_bytes(4, "little")
        step = 4 * capacity
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        for batch in batches:
            begin = 0
            for size in text_steps(batch.column("text")):
                texts = batch.column("text").slice(begin, size)
                at, rows = [], []
                for i, ids in enumerate(tokenizer.encode(texts), begin):
                    ids += tail
                    for piece, start in enumerate(range(0, len(ids), step)):
                        part = ids[start : start + step]
                        at.append(i)
                        rows.append((piece, start // 4, len(part) // 4, zlib.crc32(part), unit, item))
                        item += 1
                begin += size
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                doc_ids = batch.column("doc_id").take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([doc_ids, *columns], schema.names)

    return staged(docs.select("doc_id", "text").mapInArrow(cut, schema), "pack-pieces")


def _evolve(problems: DataFrame, capacity: int, label: str, seed: int) -> DataFrame:
    """One epoch of every island: problem, island, lengths, elites -> elite."""

    def evolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
                island = Island(lengths, [SEED, seed, row["problem"], row["island"]], capacity)
                elites = [np.frombuffer(e, "<i4").astype(np.int64) for e in row["elites"] or []]
                bins = island.evolve(elites)
                score = island.best[0]
                yield pa.RecordBatch.from_pydict(
                    {
                        "problem": pa.array([row["problem"]], pa.int64()),
                        "island": pa.array([row["island"]], pa.int32()),
                        "lengths": pa.array([row["lengths"]], pa.binary()),
                        "elite": pa.array([bins.astype("<i4").tobytes()], pa.binary()),
                        "n_bins": pa.array([-score[0]], pa.int64()),
                        "unevenness": pa.array([score[1]], pa.float64()),
                    }
                )

    schema = "problem long, island int, lengths binary, elite binary, n_bins long, unevenness double"
    return staged(problems.mapInArrow(evolve, schema), label)


def _pack_groups(dealt: DataFrame, problems: int, capacity: int, label: str, seed: int, base: int) -> DataFrame:
    """``dealt`` (unit, item, length, problem, held: the sequence it is in, if any)
    as unit, item, length, sequence_id, offset and spare: whether the sequence is
    one of the emptiest of its problem. Sequences are numbered from ``base``."""

    def gather(key: tuple[pa.Scalar, ...], frame: pa.Table) -> pa.Table:
        frame = frame.sort_by([("length", "descending"), ("unit", "ascending"), ("item", "ascending")])
        column = lambda name, kind: frame.column(name).to_numpy().astype(kind).tobytes()
        elites = None
        if frame.column("held").null_count == 0:
            _, bins = np.unique(frame.column("held").to_numpy(), return_inverse=True)
            elites = [bins.astype("<i4").tobytes()]
        return pa.table(
            {
                "problem": pa.array([key[0].as_py()], pa.int64()),
                "units": pa.array([column("unit", "<i4")], pa.binary()),
                "items": pa.array([column("item", "<i8")], pa.binary()),
                "lengths": pa.array([column("length", "<i4")], pa.binary()),
                "elites": pa.array([elites], pa.list_(pa.binary())),
            }
        )

    # About GROUP_ITEMS small rows in a group, by a hash of unique numbers.
    groups = dealt.groupBy("problem").applyInArrow(
        gather, "problem long, units binary, items binary, lengths binary, elites array<binary>"
    )
    groups = staged(groups, f"{label}-problems")
    island = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    start = groups.select("problem", island, "lengths", "elites")
    # Whole problems are single rows: spread them over tasks.
    spread = max(1, min(problems * ISLANDS, 10_000))
    state = _evolve(start.repartition(spread, "problem", "island"), capacity, f"{label}-epoch-0", seed)
    for epoch in range(1, EPOCHS):
        guests = state.select(
            "problem",
            F.expr(f"(island + 1) % {ISLANDS}").alias("island"),
            F.col("elite").alias("guest"),
        )
        state = state.join(guests, ["problem", "island"]).select(
            "problem", "island", "lengths", F.array("elite", "guest").alias("elites")
        )
        state = state.repartition(spread, "problem", "island")
        state = _evolve(state, capacity, f"{label}-epoch-{epoch}", seed + epoch)
    best = Window.partitionBy("problem").orderBy("n_bins", F.desc("unevenness"), "island")
    winners = state.withColumn("nth", F.row_number().over(best)).where("nth = 1").select("problem", "elite")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bins = np.frombuffer(row["elite"], "<i4").astype(np.int64)
                lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
                order = np.argsort(bins, kind="stable")
                upto = np.cumsum(lengths[order]) - lengths[order]
                first = np.flatnonzero(np.diff(bins[order], prepend=-1))
                offsets = np.empty(len(bins), np.int64)
                offsets[order] = upto - np.repeat(upto[first], np.diff([*first, len(bins)]))
                fills = np.bincount(bins, lengths)
                spare = np.zeros(len(fills), bool)
                spare[np.argsort(fills, kind="stable")[:SPARE_BINS]] = True
                spare &= fills < capacity
                yield pa.RecordBatch.from_pydict(
                    {
                        "unit": np.frombuffer(row["units"], "<i4"),
                        "item": np.frombuffer(row["items"], "<i8"),
                        "length": lengths,
                        "sequence_id": base + (row["problem"] << 24) + bins,
                        "offset": offsets,
                        "spare": spare[bins],
                    }
                )

    schema = "unit int, item long, length long, sequence_id long, offset long, spare boolean"
    return groups.drop("elites").join(winners, "problem").mapInArrow(place, schema)


def _pack_rests(rests: DataFrame, count: int, capacity: int) -> DataFrame:
    """sequence_id and offset for every (unit, item) of ``rests``."""
    problems = max(1, -(-count // GROUP_ITEMS))
    length = F.col("length").cast("int").alias("length")
    of_item = F.pmod(F.xxhash64("unit", "item"), F.lit(problems)).alias("problem")
    none = F.lit(None).cast("long").alias("held")
    dealt = rests.select("unit", "item", length, of_item, none)
    packed = _pack_groups(dealt, problems, capacity, "pack", 0, 0)
    places = ["unit", "item", "sequence_id", "offset"]
    if problems == 1:
        return packed.select(*places)
    packed = staged(packed, "pack-first")
    spare = packed.where("spare")
    again = max(1, -(-spare.count() // GROUP_ITEMS))
    # A sequence goes on whole, so that its packing can be kept.
    of_sequence = F.pmod(F.xxhash64("sequence_id"), F.lit(again)).alias("problem")
    dealt = spare.select("unit", "item", length, of_sequence, F.col("sequence_id").alias("held"))
    moved = _pack_groups(dealt, again, capacity, "pack-spare", EPOCHS, 1 << 61)
    return packed.where("NOT spare").select(*places).unionByName(moved.select(*places))


def pack_documents(
    docs: DataFrame, json: str | None = None, capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """Pack every row of ``docs`` (doc_id, text) into sequences of at most
    ``capacity`` tokens.

    Returns per piece doc_id, piece, start, length, ids_crc32, sequence_id and
    offset. A null or empty text has the end id alone. Only documents of more
    than ``capacity`` tokens are cut. Null and repeated ids and repeated rows
    are documents of their own; an empty table gives no rows; other columns are
    ignored. The numbers of sequences are unique and otherwise mean nothing.
    """
    pieces = cut_pieces(docs, json or tokenizer_json(), capacity, end)
    rests = pieces.where(F.col("length") < capacity)
    packed = _pack_rests(rests, rests.count(), capacity)
    # Above all numbers of packed sequences.
    alone = F.lit(1 << 62) + F.shiftleft(F.col("unit").cast("long"), 40) + F.col("item")
    full = pieces.where(F.col("length") >= capacity).select(
        *pieces.columns, alone.alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = rests.join(packed, ["unit", "item"]).select(*full.columns)
    return full.unionByName(rest).drop("unit", "item")
