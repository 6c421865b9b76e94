"""A corpus pipeline of five stages: from raw documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pitchlake.llm.exact_dedup import drop_exact_copies
from pitchlake.llm.mixing import taken_documents
from pitchlake.llm.near_dedup import drop_near_copies
from pitchlake.llm.packing import packed
from pitchlake.llm.quality import accepted_documents
from pitchlake.llm.shared import materialize

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, with all their columns.

    Null and empty texts are scored as texts without lines; ids, ties and repeated rows make
    no difference, since each row is judged by its text. An empty table gives no rows, and
    without labels to learn from all rows stay. See llm.quality."""
    return accepted_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each text, with all its columns.

    White space is compared as one space, and a null text as an empty one. Of rows that
    repeat an id and text the least stays, by all columns in order. Rows without an id stay
    only where their text has no other. An empty table gives no rows. See llm.exact_dedup."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with the smallest doc_id of each group of near duplicates, with all columns.

    Null and empty texts have no duplicates and stay, as do rows without an id; rows that
    repeat an id that stays all stay. An empty table gives no rows. See llm.near_dedup."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, with all their columns.

    A null source is a source of its own, and the last; null and empty texts have no words and
    are not taken. Rows that repeat, or have no id, are taken as all others. An empty table
    gives no rows. See llm.mixing."""
    return taken_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 token ids.

    Null texts count as empty, which have the end id alone; very long texts make many pieces;
    rows that repeat, or have no id, are packed as all others. An empty table gives no rows.
    See llm.packing."""
    return packed(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: A conditional random field, a sketch and a tokenizer are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
