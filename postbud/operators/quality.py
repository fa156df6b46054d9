"""Checks and counts of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postbud.functions.dates import parse_any_date
from postbud.functions.numbers import cast_lost
from postbud.functions.predicates import KEY, has_mojibake, is_missing, is_valid_key
from postbud.operators.conform import column_fill
from postbud.operators.ids import GROUP
from postbud.operators.keys import GATE_SCHEMA, counts_of, key_table, totals


class GateFailed(ValueError):
    def __init__(self, failures):
        self.failures = failures
        super().__init__(
            "; ".join(
                f"{r['gate']} {r['suffix']}{' ' + r['region'] if r['region'] else ''}: "
                f"{r['failures']}{' (' + r['sample'] + ')' if r['sample'] else ''}"
                for r in failures
            )
        )


def qc_summary(delivery: DataFrame) -> DataFrame:
    """Rows and rows still without a municipality per region and month."""
    return delivery.groupBy(F.col("region").alias("RHF"), "suffix").agg(
        F.count("*").alias("rows"),
        F.count_if(is_missing(F.col("KommuneNr"))).alias("missing_kommune"),
    )


def month_control(delivery: DataFrame, year: int) -> DataFrame:
    """Rows of one year by the month of the start date, per region."""
    return (
        delivery.where(F.col("År").try_cast("int") == year)
        .groupBy("region", F.month(parse_any_date(F.col("StartDato"))).alias("month"))
        .agg(F.count("*").alias("n_rows"))
    )


def cast_loss(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("region",)) -> DataFrame:
    """Per group and column: filled cells, and filled cells that have no integer reading."""
    counts = []
    for c in columns:
        cell = F.col(c).cast("string")
        counts += [
            F.count_if(cell.isNotNull() & (cell != "")).alias(f"{c}_nonempty"),
            F.count_if(cast_lost(cell)).alias(f"{c}_lost"),
        ]
    return df.groupBy(*by).agg(*counts)


def mojibake_by_column(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cells with marks of a wrong encoding, one row per column, from one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(*[F.count_if(has_mojibake(F.col(c))).alias(c) for c in columns])
    return _one_row_per_column(counted, columns, "n_mojibake")


def empty_column_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whether each column is wholly empty, one row per column, from one pass."""
    columns = list(columns or df.columns)
    filled = column_fill(df, columns=columns)
    flags = filled.select(*[(~F.coalesce(F.col(c), F.lit(True))).alias(c) for c in columns])
    return _one_row_per_column(flags, columns, "is_empty")


def _one_row_per_column(one_row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias(value)) for c in columns]
    return one_row.select(F.inline(F.array(*pairs)))


def missing_by_group(df: DataFrame, wanted: Sequence[str], by: Sequence[str] = GROUP) -> DataFrame:
    """Wanted columns a group does not have or never fills, one row each."""
    have = [c for c in wanted if c in df.columns]
    filled = column_fill(df, by=by, columns=have).select(
        *by, *have, *[F.lit(False).alias(c) for c in wanted if c not in have]
    )
    pairs = [F.struct(F.lit(c).alias("missing_column"), F.col(c).alias("filled")) for c in wanted]
    return filled.select(*by, F.inline(F.array(*pairs))).where(~F.col("filled")).drop("filled")


def id_profile(profile: DataFrame) -> DataFrame:
    """Rows, distinct keys with sentinels and a NULL counted once each, and valid keys."""
    per_key = profile.groupBy("suffix", KEY).agg(F.sum("n_rows").alias("n_rows"))
    return per_key.groupBy("suffix").agg(
        F.sum("n_rows").alias("n_rows"),
        F.count("*").alias("n_distinct"),
        F.count_if(is_valid_key(F.col(KEY))).alias("n_valid"),
    )


def delivery_counts(
    profile: DataFrame,
    id_map: DataFrame,
    fixes: DataFrame | None,
    integer_columns: Sequence[str] = (),
) -> DataFrame:
    """What a delivery will hold, from the key profile alone.

    The profile counts lost casts of report columns; those of the number come from the mapping.
    """
    return counts_of(totals(key_table(profile, id_map, fixes), integer_columns))


def mojibake_by_group(df: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Cells of all columns with marks of a wrong encoding per group, from one pass; groups without are left out."""
    cells = sum((has_mojibake(F.col(f"`{c}`")).cast("long") for c in df.columns if c not in by), F.lit(0))
    return df.groupBy(*by).agg(F.sum(cells).alias("n_mojibake")).where("n_mojibake > 0")


def gate_table(spark: SparkSession, rows: Sequence) -> DataFrame:
    """Failed checks that were told by files or by a run, as one table; at most one per check, region and month."""
    return spark.createDataFrame([tuple(r) for r in rows], GATE_SCHEMA)


def enforce(failures: Sequence, stopping: Sequence[str]) -> list:
    """Raise if a stopping check failed, else return the failed checks as warnings.

    Takes collected rows: there is at most one per check, region and month.
    """
    stop = [r for r in failures if r["gate"] in stopping]
    if stop:
        raise GateFailed(stop)
    return list(failures)
