"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A document's place on the ring is the hash of its text, so equal texts start at
the same shard. Every shard takes what reaches it until it holds its fair share
of the bytes; what overflows continues clockwise to the next shard with room.

The walk is done on cells, not on rows: a cell is one of POINTS ring points and
one of SALTS parts of the documents there, cut by the hash of the id. There are
at most POINTS * SALTS cells whatever the input, and a text that a third of all
rows share is spread over SALTS of them. A shard exceeds its share by less than
one cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirflow.llm.common import staged
from weirflow.session import cut_lineage

POINT_BITS, SALTS = 10, 256
POINTS = 1 << POINT_BITS
VIRTUAL_NODES = 64
# Positions have 62 bits, so that differences of two fit a long.
_RING = 1 << 62


def ring_preferences(spark: SparkSession, shards: int, nodes: int = VIRTUAL_NODES) -> DataFrame:
    """For each ring point the shards in clockwise order: point, turn (from 1), shard.

    A shard's virtual nodes do not depend on the number of shards, so a new
    shard takes over arcs and leaves all other arcs as they are.
    """
    per_point = shards * nodes
    pairs = spark.range(POINTS * per_point).select(
        F.expr(f"CAST(id DIV {per_point} AS INT)").alias("point"),
        F.expr(f"CAST(id % {shards} AS INT)").alias("shard"),
        F.expr(f"CAST(id % {per_point} DIV {shards} AS INT)").alias("replica"),
    )
    node = F.shiftrightunsigned(F.xxhash64(F.lit("node"), "shard", "replica"), 2)
    here = F.shiftleft(F.col("point").cast("long"), 62 - POINT_BITS)
    nearest = pairs.groupBy("point", "shard").agg(
        F.min(F.pmod(node - here, F.lit(_RING))).alias("distance")
    )
    clockwise = Window.partitionBy("point").orderBy("distance", "shard")
    return nearest.select("point", F.row_number().over(clockwise).alias("turn"), "shard")


def _place(cells: DataFrame, shards: int) -> DataFrame:
    """Give every cell a shard. In each turn the cells without one ask the next
    shard clockwise, which takes them in ring order while it has room."""
    spark = cells.sparkSession
    turns = staged(ring_preferences(spark, shards), "ring")
    total = cells.agg(F.sum("bytes")).first()[0] or 0
    room = -(-total // shards)
    state = cells.withColumns({"shard": F.lit(None).cast("int"), "turn": F.lit(None).cast("int")})
    for turn in range(1, shards + 1):
        placed = state.where(F.col("shard").isNotNull())
        waiting = state.where(F.col("shard").isNull()).drop("shard", "turn")
        loads = placed.groupBy("shard").agg(F.sum("bytes").alias("load"))
        asked = turns.where(F.col("turn") == turn).join(loads, "shard", "left")
        ahead = (
            Window.partitionBy("asked")
            .orderBy("point", "salt")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        full = F.coalesce("load", F.lit(0)) + F.coalesce(F.sum("bytes").over(ahead), F.lit(0))
        answered = (
            waiting.join(asked.withColumnRenamed("shard", "asked"), "point")
            .withColumn("fits", full < room)
            .withColumn("shard", F.expr("IF(fits, asked, NULL)"))
            .withColumn("turn", F.expr("IF(fits, turn, NULL)"))
        )
        state = cut_lineage(placed.unionByName(answered.select(*placed.columns)))
        if state.where(F.col("shard").isNull()).isEmpty():
            break
    return state


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shard and slot of every row of ``docs`` (columns doc_id and text).

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law
    (``bytes``: sizes are near equal), shard, slot (gapless from 0 in its
    shard), grown_shard (null: only a ``key`` law has one), home_shard (where
    the ring alone would put it) and turn (how far clockwise it went, from 1).

    A null text counts as no bytes and has the checksum of none. Null ids,
    repeated ids and repeated rows are rows like any other; equal rows may swap
    their slots. An empty input gives no rows. Other columns are ignored.
    """
    rows = staged(
        docs.select(
            F.col("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64("text"), 64 - POINT_BITS).cast("int").alias("point"),
            F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
        ),
        "ring-rows",
    )
    cells = cut_lineage(
        rows.groupBy("point", "salt").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    )
    placed = _place(cells, shards)
    home = ring_preferences(docs.sparkSession, shards).where("turn = 1")
    before = (
        Window.partitionBy("shard")
        .orderBy("point", "salt")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = placed.withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    placed = placed.join(home.select("point", F.col("shard").alias("home_shard")), "point")
    in_cell = Window.partitionBy("point", "salt").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("nth", F.row_number().over(in_cell))
        .join(placed, ["point", "salt"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("nth") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "home_shard",
            "turn",
        )
    )
