"""Mixing sources to target weights by a low-discrepancy schedule.

The schedule goes through the points k * F(n-1) mod F(n), a golden-ratio lattice
of Fibonacci numbers that visits each of 0 .. F(n) - 1 once. Every source covers
as many points as it is to have slots, and the one that covers a point gets the
slot; points beyond the last source are passed over. So each source has exactly
its slots, and any stretch of the schedule is close to the shares. The n-th slot
of a source takes its n-th block: the source's documents in shuffled order, cut
into blocks of equally many words, over and over for at most ``max_epochs``
rounds. Small sources have smaller blocks, so that rounding to whole slots is a
small part of any source.

Nothing is gathered per source: running sums go through hash buckets (words) or
chunks of slots (ranks) whose totals are small tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import staged, unused
from weirflow.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WORD_AND_BEFORE = r"[\x20\x09-\x0D]*" + WORD
# About a million slots; blocks grow to at most BLOCK_WORDS words, so beyond
# a billion words the number of slots follows the input.
SLOTS, BLOCK_WORDS = 1 << 20, 1024
# A source's blocks are small enough for so many slots, if it has the words.
LEAST_SLOTS = 32
# Beyond so many slots blocks grow again: products of points have to fit a long.
MOST_SLOTS = 1 << 31
FIBONACCI = [1, 2]
while FIBONACCI[-1] < MOST_SLOTS:
    FIBONACCI.append(FIBONACCI[-1] + FIBONACCI[-2])
CELL_BITS, BUCKET_BITS, CHUNK_BITS = 12, 12, 16


def source_targets(
    rows: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3
) -> DataFrame:
    """One row per source of ``rows`` (source, size): source, source_no (by code
    point, null last), source_size and target, in words.

    Targets share all words by weight. One above ``max_epochs`` times its source
    stops there, and the rest shares the excess by weight. With r the limit over
    the weight, in ascending order, the sources before the first whose r reaches
    the common level (words left over weight left) are those that stop.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    total = Window.partitionBy()
    by_limit = Window.orderBy("ratio", "source_no")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(0, Window.unboundedFollowing)
    limit = F.col("source_size").cast("double") * max_epochs
    return (
        sizes.withColumn("source_no", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(cycle, F.col("source_no") % len(weights) + 1))
        .withColumn("limit", limit)
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("words", F.sum("source_size").over(total).cast("double"))
        .withColumn("left", F.col("words") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(onward))
        .withColumn("common", F.max(F.expr("IF(level <= ratio, level, NULL)")).over(total))
        .withColumn("target", F.least("limit", F.col("weight") * F.col("common")))
        .select("source", "source_no", "source_size", "target")
    )


def _shares(targets: DataFrame, block: int) -> tuple[DataFrame, int]:
    """The targets with the words of each source's blocks (at most ``block``),
    their number and the source's part [lo, hi) of the points, and the number of
    slots that the targets come to."""
    own = f"least(source_size, target) / {LEAST_SLOTS}"
    size = F.expr(f"CAST(greatest(1, least({block}, {own})) AS BIGINT)")
    blocks = F.expr("(source_size + block_size - 1) DIV block_size")
    expected = F.expr("IF(source_size > 0, target * blocks / source_size, 0D)")
    upto = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    shares = targets.withColumn("block_size", size).withColumn("blocks", blocks)
    shares = shares.withColumn("expected", expected)
    shares = shares.withColumn("hi", F.round(F.sum("expected").over(upto)).cast("long"))
    shares = shares.withColumn(
        "lo", F.coalesce(F.lag("hi").over(Window.orderBy("source_no")), F.lit(0))
    )
    shares = cut_lineage(shares)
    return shares, shares.agg(F.max("hi")).first()[0] or 0


def schedule_slots(shares: DataFrame, slots: int, max_epochs: int = 3) -> DataFrame:
    """The schedule: slot, source_no, rank (from 0 in its source), block, epoch.

    A slot beyond the last epoch of its source, which can only come from the
    rounding of a target that stops there, takes nothing and is left out.
    """
    n = next((i for i, f in enumerate(FIBONACCI) if f >= slots), None)
    if n is None:
        raise ValueError(f"{slots} slots are more than {FIBONACCI[-1]}")
    modulus, step = FIBONACCI[n], FIBONACCI[max(0, n - 1)]
    shift = max(0, modulus.bit_length() - CELL_BITS)
    # Points are looked up by equality on their cell; there are at most
    # 2^CELL_BITS cells plus one per source.
    cells = shares.where("hi > lo").select(
        "source_no",
        "blocks",
        "lo",
        "hi",
        F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))).alias("cell"),
    )
    drawn = shares.sparkSession.range(modulus if slots else 0).select(
        "id", F.expr(f"(id * {step}L) % {modulus}L").alias("point")
    )
    drawn = drawn.where(F.col("point") < slots).withColumn("cell", F.shiftright("point", shift))
    drawn = drawn.join(cells, "cell").where("point >= lo AND point < hi")
    drawn = drawn.select(
        "id", "source_no", "blocks", F.shiftright("id", CHUNK_BITS).alias("chunk")
    )
    # What lies before each chunk, of its source and in all; points that were
    # passed over have no number.
    chunks = drawn.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("here"))
    chunks = cut_lineage(chunks)
    earlier = (
        Window.partitionBy("source_no")
        .orderBy("chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = chunks.select(
        "source_no", "chunk", F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("first")
    )
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.groupBy("chunk").agg(F.sum("here").alias("all_here"))
    starts = starts.select("chunk", F.coalesce(F.sum("all_here").over(before), F.lit(0)).alias("start"))
    first = first.join(starts, "chunk")
    in_chunk = Window.partitionBy("chunk").orderBy("id")
    of_source = Window.partitionBy("source_no", "chunk").orderBy("id")
    ranked = (
        drawn.withColumn("in_chunk", F.row_number().over(in_chunk) - 1)
        .withColumn("nth", F.row_number().over(of_source) - 1)
        .join(first, ["source_no", "chunk"])
    )
    rank = F.col("first") + F.col("nth")
    return (
        ranked.withColumn("rank", rank)
        .where(F.col("rank") < F.col("blocks") * max_epochs)
        .select(
            (F.col("start") + F.col("in_chunk")).alias("slot"),
            "source_no",
            "rank",
            F.expr("rank % blocks").alias("block"),
            F.expr("rank DIV blocks").alias("epoch"),
        )
    )


def _shuffled_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``: the words of the source that come before the row when its
    documents are shuffled by the hash of their ids."""
    mixed = rows.withColumn("shuffle", F.xxhash64(F.lit("mix"), "doc_id"))
    mixed = mixed.withColumn("bucket", F.shiftrightunsigned("shuffle", 64 - BUCKET_BITS))
    buckets = mixed.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    earlier = (
        Window.partitionBy("source_no")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = buckets.select(
        "source_no", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("first")
    )
    in_bucket = (
        Window.partitionBy("source_no", "bucket")
        .orderBy("shuffle", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = F.coalesce(F.sum("size").over(in_bucket), F.lit(0))
    return (
        mixed.withColumn("ahead", ahead)
        .join(first, ["source_no", "bucket"])
        .withColumn("start", F.col("first") + F.col("ahead"))
        .drop("shuffle", "bucket", "first", "ahead")
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    max_epochs: int = 3,
    block_words: int | None = None,
) -> DataFrame:
    """How many words of each row of ``docs`` (doc_id, text, source) the mix takes.

    Returns doc_id, source, size (words), source_size, target (its source's) and
    taken. A document is taken whole ``taken DIV size`` times, and then by its
    first ``taken % size`` words.

    A null or empty text has size 0 and is never taken; a null source is a
    source of its own, the last one. Null and repeated ids are rows like any
    other; equal rows may swap their results. An empty input gives no rows.
    Other columns are ignored.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = staged(docs.select("doc_id", "source", words.alias("size")), "mix-rows")
    targets = cut_lineage(source_targets(rows, weights, max_epochs))
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    block = block_words or max(1, min(BLOCK_WORDS, total // SLOTS), total // MOST_SLOTS)
    shares, slots = _shares(targets, block)
    schedule = schedule_slots(shares, slots, max_epochs)
    times = schedule.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("times"))

    numbered = rows.join(
        shares.select(F.col("source").alias("name"), "source_no", "source_size", "target", "block_size"),
        F.col("source").eqNullSafe(F.col("name")),
    ).drop("name")
    placed = staged(_shuffled_starts(numbered), "mix-placed")
    # Parts of documents by block: as many as there are blocks and documents.
    parts = placed.where("size > 0").select(
        "source_no",
        "start",
        "size",
        "block_size",
        F.explode(F.expr("sequence(start DIV block_size, (start + size - 1) DIV block_size)")).alias("block"),
    )
    overlap = F.expr(
        "least(start + size, (block + 1) * block_size) - greatest(start, block * block_size)"
    )
    # The size that Spark expects of the parts leaves out that documents have many:
    # no broadcast.
    taken = (
        parts.hint("merge")
        .join(times, ["source_no", "block"])
        .groupBy("source_no", "start")
        .agg(F.sum(overlap * F.col("times")).alias("taken"))
    )
    # Documents with words have starts of their own in their source.
    has_words = placed.where("size > 0").join(taken, ["source_no", "start"], "left")
    without = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return has_words.unionByName(without).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def whole_documents(mix: DataFrame) -> DataFrame:
    """``mix`` without partial takings: the document that a source takes in part
    is taken whole once more, or left, whichever brings the source nearer to its
    target. Where nothing else of a source is taken, it is taken.

    Takings stay within the limit, as a partial one is below it.
    """
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(F.lit(0).cast("long"))
    totals = mix.groupBy("source").agg(F.sum(F.col("taken") - rest).alias("_given"))
    totals = totals.withColumnRenamed("source", "_source")
    far = F.abs(F.col("_given") - F.col("target"))
    nearer = F.abs(F.col("_given") + F.col("size") - F.col("target")) <= far
    more = (rest > 0) & ((F.col("_given") == 0) | nearer)
    taken = F.col("taken") - rest + F.when(more, F.col("size")).otherwise(F.lit(0).cast("long"))
    joined = mix.join(totals, F.col("source").eqNullSafe(F.col("_source")))
    return joined.withColumn("taken", taken).select(*mix.columns)


def render_mix(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them, with their columns.

    The last, partial taking of a document holds its characters up to the last
    of its first words; there is at most one such document per source, and none
    after ``whole_documents``. Rows that share id and source are taken alike. ``n_chars`` is kept right if there is
    one.
    """
    key, source, whole, rest, copy = (
        unused(name, docs) for name in ("_id", "_source", "_whole", "_rest", "_copy")
    )
    times = F.struct(F.expr("taken DIV size").alias("whole"), F.expr("CAST(taken % size AS INT)").alias("rest"))
    chosen = (
        mix.where("taken > 0")
        .groupBy(F.col("doc_id").alias(key), F.col("source").alias(source))
        .agg(F.min(times).alias("times"))
        .select(key, source, F.col("times.whole").alias(whole), F.col("times.rest").alias(rest))
    )
    same = F.col("doc_id").eqNullSafe(F.col(key)) & F.col("source").eqNullSafe(F.col(source))
    takings = F.col(whole) + F.when(F.col(rest) > 0, F.lit(1)).otherwise(F.lit(0))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), takings))
    taken = docs.join(chosen, same).withColumn(copy, copies)
    cut = F.col(copy) > F.col(whole)
    words = F.regexp_extract_all("text", F.lit(WORD_AND_BEFORE), 0)
    first = F.array_join(F.slice(words, 1, F.col(rest)), "")
    taken = taken.withColumn("text", F.when(cut, first).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        taken = taken.withColumn("n_chars", F.when(cut, chars).otherwise(F.col("n_chars")))
    return taken.select(*docs.columns)
