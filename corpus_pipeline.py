"""Documents to a training mix: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postbud.llm import decontaminate, language, line_dedup, mixing, near_dup
from postbud.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language.keep_accepted),
    ("line_dedup", line_dedup.drop_repeated_lines),
    ("minhash_near_dedup", near_dup.keep_one),
    ("benchmark_decontamination", decontaminate.drop_contaminated),
    ("source_mixing", mixing.mix),
]

# Language models, samples and the decomposition have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
