"""Registered queries of the operators, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillroll.llm.bpe import encode_decode
from tillroll.llm.burst_trie import conversation_trie
from tillroll.llm.content_sort import exact_duplicates
from tillroll.llm.divergence import source_divergence
from tillroll.llm.grid_order import near_vectors
from tillroll.llm.kneser_ney import toxicity
from tillroll.llm.language import language_id
from tillroll.llm.latent import benchmark_matches
from tillroll.llm.minhash import near_duplicates
from tillroll.llm.oracles import ORACLES
from tillroll.llm.page_text import main_text
from tillroll.llm.pii import personal_data
from tillroll.llm.quality import quality
from tillroll.llm.tables import table
from tillroll.llm.token_files import token_files


def op1_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(spark, table(spark, sf_dir, "documents"))


def op2_grid_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark, table(spark, sf_dir, "embeddings"))


def op3_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_latent_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return benchmark_matches(spark, docs, items)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark, table(spark, sf_dir, "pages"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


def op9_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(spark, table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_decode(table(spark, sf_dir, "documents"), ranks)


def op11_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark, table(spark, sf_dir, "conversations"))


def op12_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark, table(spark, sf_dir, "documents"))


def op13_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(spark, table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bootstrapped_pii": op1_bootstrapped_pii,
    "op2_grid_order": op2_grid_order,
    "op3_rule_ensemble": op3_rule_ensemble,
    "op4_latent_retrieval": op4_latent_retrieval,
    "op5_minhash": op5_minhash,
    "op6_kneser_ney": op6_kneser_ney,
    "op7_suffix_array": op7_suffix_array,
    "op8_token_files": op8_token_files,
    "op9_output_codes": op9_output_codes,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_burst_trie": op11_burst_trie,
    "op12_content_sort": op12_content_sort,
    "op13_transducer": op13_transducer,
}

__all__ = ["ORACLES", "QUERIES"]
