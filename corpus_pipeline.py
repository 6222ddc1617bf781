"""From raw documents to packed sequences: language, duplicates, mix, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next one's documents. All but the last return the
columns of the documents table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import langid, mixing, neardup, packing
from weirflow.llm.common import staged, table

# A document goes if no language is at least this probable.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised: those with a letter, and
    with one language more probable than all others together. Their columns stay
    as they are, also one with the name of a prediction."""
    own = {name: f"own {i} {name}" for i, name in enumerate(docs.columns) if name.lower() in ("lang_pred", "score")}
    found = langid.identify(docs.withColumnsRenamed(own), langid.learn(docs))
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.where(known).select(*[F.col(f"`{own.get(name, name)}`").alias(name) for name in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group, and all without a group."""
    dropped = neardup.near_duplicates(docs).where("NOT kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out whole documents as the mix takes them."""
    return mixing.render_mix(docs, mixing.whole_documents(mixing.mix_sources(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document is in the sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

# The model of stage 1 and the tokenizer of stage 4 cannot be told in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
