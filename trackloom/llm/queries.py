"""The registered queries of this subpackage: thin functions over its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trackloom.llm import oracles
from trackloom.llm.bpe import encode_texts
from trackloom.llm.decision_list import quality_verdicts
from trackloom.llm.exact_dedup import exact_duplicates
from trackloom.llm.html_extract import extract
from trackloom.llm.mixing import mix_report
from trackloom.llm.near_dedup import near_duplicates
from trackloom.llm.ranked_search import ranked_search
from trackloom.llm.sharding import SHARDS, place
from trackloom.llm.spelling import spelling_variants
from trackloom.llm.storage import table
from trackloom.llm.substring_dedup import remove_repeated_spans
from trackloom.llm.suffix_dedup import remove_repeated_bytes
from trackloom.llm.vector_dedup import near_vectors
from trackloom.llm.wordpiece import token_counts

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_spans(table(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return place(docs, "doc_id", [f"shard-{i:04d}" for i in range(SHARDS)]).select("doc_id", "slot", "shard")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"))


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    """Learned rules, hashed draws, vocabularies and page markup have no SQL: tests hold them against plain loops."""
    return {
        "op1_substring_dedup": oracles.SUBSTRING_DEDUP,
        "op2_near_dedup": oracles.NEAR_DEDUP,
        "op4_suffix_dedup": oracles.SUFFIX_DEDUP,
        "op10_vector_dedup": oracles.VECTOR_DEDUP,
        "op11_ranked_search": oracles.RANKED_SEARCH,
        "op12_spelling": oracles.SPELLING,
        "op13_exact_dedup": oracles.EXACT_DEDUP,
    }
