"""Person keys: the request list, the key profile, checks of the returned mapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from postbud.functions.numbers import cast_lost
from postbud.functions.predicates import (
    KEY,
    NUMBER,
    column_or_null,
    has_mojibake,
    is_missing,
    is_valid_key,
)

RUN_KEY = ["suffix", KEY]
GROUP = ["suffix", "region"]


def request_ids(report: DataFrame) -> DataFrame:
    """Distinct valid keys per month, with the empty second column the receiver expects."""
    return (
        report.where(is_valid_key(F.col(KEY)))
        .select(*RUN_KEY)
        .distinct()
        .withColumn("Dummy", F.lit(""))
    )


def key_profile(report: DataFrame, integer_columns: Sequence[str] = ()) -> DataFrame:
    """Counts per month, region and key.

    Partial aggregation leaves one row per key in each task before anything is shuffled, so
    a key that holds a third of the rows costs no more than any other. Everything a run must
    know before the wide join comes from this table: requests, checks, people without a
    municipality, row counts of the deliveries.
    """
    casts = [c for c in integer_columns if c != NUMBER]
    aggregates = [
        F.count("*").alias("n_rows"),
        F.count_if(is_missing(column_or_null(report, "KommuneNr"))).alias("n_no_kommune"),
        F.count_if(~is_missing(column_or_null(report, "År"))).alias("n_year"),
        F.count_if(has_mojibake(column_or_null(report, "Pakkeforløp"))).alias("n_mojibake"),
    ]
    for c in casts:
        cell = column_or_null(report, c)
        aggregates += [
            F.count_if(cell.isNotNull() & (cell != "")).alias(f"n_filled_{c}"),
            F.count_if(cast_lost(cell)).alias(f"n_lost_{c}"),
        ]
    return report.groupBy(*GROUP, KEY, own_number(report).alias("own_number")).agg(*aggregates)


def own_number(report: DataFrame) -> Column:
    """Whether a row brings its own run number in a column with a broken name."""
    return ~is_missing(column_or_null(report, "enr"))


def usable_numbers(id_map: DataFrame) -> DataFrame:
    return id_map.where(is_valid_key(F.col(KEY)) & ~is_missing(F.col(NUMBER)))


def duplicate_keys(id_map: DataFrame) -> DataFrame:
    """Keys the returned mapping holds more than once."""
    return (
        id_map.where(F.col(KEY).isNotNull() & (F.col(KEY) != ""))
        .groupBy(*RUN_KEY)
        .agg(F.count("*").alias("n"))
        .where("n > 1")
    )


def unmapped_ids(needed: DataFrame, id_map: DataFrame) -> DataFrame:
    """Needed keys without a usable run number, with whatever was returned for them."""
    return (
        needed.where(is_valid_key(F.col(KEY)))
        .select(*RUN_KEY)
        .distinct()
        .join(id_map.select(*RUN_KEY, NUMBER), RUN_KEY, "left")
        .where(is_missing(F.col(NUMBER)))
    )


def first_examples(keys: DataFrame, n: int = 10) -> DataFrame:
    """The first keys of each month in order, as one text per month."""
    order = Window.partitionBy("suffix").orderBy(KEY)
    return (
        keys.select(*RUN_KEY, F.row_number().over(order).alias("place"))
        .where(F.col("place") <= n)
        .groupBy("suffix")
        .agg(F.array_join(F.array_sort(F.collect_list(KEY)), ", ").alias("sample"))
    )


def attach_numbers(report: DataFrame, id_map: DataFrame) -> DataFrame:
    """Rows of people who have a run number, with that number."""
    return (
        report.where(is_valid_key(F.col(KEY)))
        .join(id_map.select(*RUN_KEY, NUMBER), RUN_KEY, "left")
        .where(~is_missing(F.col(NUMBER)))
    )
