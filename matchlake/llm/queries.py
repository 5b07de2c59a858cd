"""The thin contract queries, one for each operator: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import table
from matchlake.llm.decontaminate import contamination
from matchlake.llm.exact_dedup import exact_dedup
from matchlake.llm.jaccard import jaccard_components
from matchlake.llm.licenses import license_scan
from matchlake.llm.lm import lm_scores
from matchlake.llm.merkle import manifest
from matchlake.llm.mixing import mix
from matchlake.llm.quality import quality_scores
from matchlake.llm.secrets import secret_spans
from matchlake.llm.simhash import near_duplicates
from matchlake.llm.substring_dedup import kept_digests
from matchlake.llm.toxicity import toxicity_scores
from matchlake.llm.trie import prefix_trie


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join("all", ",").alias("spans"), "n_entropy")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("digest")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_digests(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op11_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_secrets, op2_licenses, op3_quality, op4_substring_dedup, op5_mixing, op6_toxicity, op7_exact_dedup, op8_simhash,
                                   op9_decontamination, op10_lm, op11_jaccard, op12_merkle, op13_prefix_trie)}
