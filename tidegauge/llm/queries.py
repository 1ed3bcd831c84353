"""Queries of the operators over the shared tables: name -> (Spark query, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import table
from . import bpe, chat, collocations, gam, licenses, merkle, mixing, prefix_trie, simhash, suffix_dedup, suffix_tree, topk, toxicity

Run = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file on the driver."""
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(table(spark, sf_dir, "conversations"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_report(table(spark, sf_dir, "documents"), vocabulary())


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_report(table(spark, sf_dir, "embeddings"))


def op8_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_report(table(spark, sf_dir, "documents"))


def op9_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.lm_scores(table(spark, sf_dir, "documents"))


def op10_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_report(table(spark, sf_dir, "conversations"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_report(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, tuple[Run, str | None]] = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_license_scan": (op2_license_scan, licenses.SQL),
    "op3_mix_sources": (op3_mix_sources, mixing.SQL),
    "op4_chat_format": (op4_chat_format, chat.SQL),
    "op5_simhash": (op5_simhash, None),
    "op6_bpe": (op6_bpe, None),
    "op7_topk_search": (op7_topk_search, topk.SQL),
    "op8_merkle_fingerprints": (op8_merkle_fingerprints, merkle.SQL),
    "op9_suffix_tree_lm": (op9_suffix_tree_lm, None),
    "op10_quality_gam": (op10_quality_gam, None),
    "op11_prefix_trie": (op11_prefix_trie, prefix_trie.SQL),
    "op12_suffix_dedup": (op12_suffix_dedup, None),
    "op13_collocations": (op13_collocations, collocations.SQL),
}
