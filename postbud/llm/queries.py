"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postbud.llm import (
    align,
    decontaminate,
    fingerprints,
    hard_negatives,
    html,
    language,
    line_dedup,
    mixing,
    near_dup,
    suffix_dedup,
    tokens,
    url_filter,
    warc,
)


def _of(table: str, operator: Callable[[DataFrame], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    return query


def _decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return decontaminate.contaminated(*tables)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_near_dedup": _of("documents", near_dup.near_duplicates),
        "op2_document_fingerprints": _of("documents", fingerprints.fingerprints),
        "op3_suffix_array_dedup": _of("documents", suffix_dedup.suffix_dedup_digests),
        "op4_line_dedup": _of("documents", line_dedup.line_dedup_digests),
        "op5_source_mixing": _of("documents", mixing.mixture),
        "op6_html_main_text": _of("pages", html.main_text),
        "op7_token_counts": _of("documents", tokens.token_counts),
        "op8_warc_round_trip": _of("pages", warc.round_trip),
        "op9_benchmark_decontamination": _decontaminated,
        "op10_language_id": _of("documents", language.identify),
        "op11_hard_negatives": _of("embeddings", hard_negatives.hard_negatives),
        "op12_token_alignment": _of("documents", align.alignments),
        "op13_url_filter": _of("pages", url_filter.judge),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_line_dedup": line_dedup.ORACLE,
        "op5_source_mixing": mixing.ORACLE,
        "op11_hard_negatives": hard_negatives.ORACLE,
        "op13_url_filter": url_filter.ORACLE,
    }
