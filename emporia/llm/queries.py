"""The registered queries: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm.common import table
from emporia.llm import (
    bpe,
    credentials,
    decontaminate,
    fill_middle,
    html_paths,
    huffman,
    langid,
    line_chunks,
    link_trust,
    merkle,
    perm_index,
    token_counts,
)
from emporia.llm.simhash_golay import near_duplicate_groups


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedup_lines(table(spark, sf_dir, "documents"))


def op3_tag_path_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_paths.extract(table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.find_secrets(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op8_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.round_trip(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "item_id", F.round("score", 6).alias("score"), "first_char", "last_char"))


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perm_index.search(table(spark, sf_dir, "embeddings"))


def op11_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judge(table(spark, sf_dir, "pages"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_line_dedup, op3_tag_path_html, op4_language_id, op5_forced_boundary_bpe,
        op6_secret_scan, op7_token_counts, op8_huffman_ids, op9_decontamination, op10_permutation_index, op11_link_trust, op12_fill_middle, op13_merkle_manifest)
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": line_chunks.oracle_sql(),
    "op11_link_trust": link_trust.oracle_sql(),
    "op12_fill_middle": fill_middle.oracle_sql(),
    "op13_merkle_manifest": merkle.oracle_sql(),
}
