"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .exact_dedup import exact_groups
from .lexical_search import ranked
from .mixing import mixed
from .near_dedup import near_duplicates
from .packing import packed
from .periodic_runs import periodic_runs, run_digests, with_repeating_words
from .quality import quality_scores
from .quotations import reply_ordered
from .sharding import balanced_shards
from .substring_dedup import repeated_passages
from .token_files import token_files_round_trip
from .topk import nearest
from .url_filters import judged_urls, rule_table

# The rules by which URLs are judged.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(_table(spark, sf_dir, "documents"), shards=8)


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(_table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files_round_trip(_table(spark, sf_dir, "documents"), TOKENIZER)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(_table(spark, sf_dir, "conversations"))


def op10_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"), TOKENIZER, length=2048)


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_urls(_table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_repeating_words(_table(spark, sf_dir, "documents"))))


QUERIES = {
    "op1_line_quality": op1_line_quality,
    "op2_balanced_shards": op2_balanced_shards,
    "op3_repeated_passages": op3_repeated_passages,
    "op4_source_mix": op4_source_mix,
    "op5_token_files": op5_token_files,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_near_dedup": op8_near_dedup,
    "op9_quotation_links": op9_quotation_links,
    "op10_packed_sequences": op10_packed_sequences,
    "op11_url_filters": op11_url_filters,
    "op12_ranked_search": op12_ranked_search,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES = {
    "op3_repeated_passages": oracles.SUBSTRING_DEDUP,
    "op4_source_mix": oracles.SOURCE_MIX,
    "op6_exact_top_k": oracles.TOP_K,
    "op7_exact_dedup": oracles.EXACT_DEDUP,
    "op8_near_dedup": oracles.NEAR_DEDUP,
    "op11_url_filters": oracles.URL_FILTERS,
    "op12_ranked_search": oracles.RANKED_SEARCH,
}
