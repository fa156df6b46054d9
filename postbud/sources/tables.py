"""The other inputs: returned numbers, location history, inline tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postbud.functions.predicates import KEY, NUMBER
from postbud.functions.text import blank_to_null, strip_cr, strip_semicolons, trim_blanks
from postbud.layout import LOCATION_OVERRIDES, RETURN_NAME
from postbud.sources.files import as_literal_path, export_of, list_files, path_exists

HISTORY_SCHEMA = "NPRId string, komnrhjem2 string, bydel2 string, aar int"


class MissingReturnFile(FileNotFoundError):
    pass


def _return_path(app_dir: str, suffix: str) -> str:
    return f"{app_dir}/{RETURN_NAME.format(suffix=suffix)}"


def missing_returns(spark: SparkSession, app_dir: str, suffixes: Sequence[str]) -> list[str]:
    """Months that no returned file was found for."""
    return [s for s in suffixes if not path_exists(spark, _return_path(app_dir, s))]


def read_returns(
    spark: SparkSession, app_dir: str, suffixes: Sequence[str], skip_missing: bool = False
) -> DataFrame:
    """Returned files of all months: key and run number, cleaned, blanks as NULL.

    The files have no header; fields after the second are ignored. Keys and numbers hold no line
    feeds, so the files are split at every one. A month without a file is an error, or with
    ``skip_missing`` a month without rows.
    """
    lost = missing_returns(spark, app_dir, suffixes)
    if lost and not skip_missing:
        raise MissingReturnFile(f"no returned file {', '.join(_return_path(app_dir, s) for s in lost)}")
    paths = {s: _return_path(app_dir, s) for s in suffixes if s not in lost}
    if not paths:
        return spark.createDataFrame([], f"suffix string, {KEY} string, {NUMBER} string")
    months = {p.rsplit("/", 1)[-1]: s for s, p in paths.items()}
    places = [
        (r["uri"], months[r["path"].rsplit("/", 1)[-1]])
        for r in list_files(spark, paths.values()).collect()
    ]
    rows = (
        spark.read.schema(f"{KEY} string, {NUMBER} string")
        .options(
            header=False, sep=";", quote='"', escape='"', lineSep="\n",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
        .csv([as_literal_path(p) for p in paths.values()])
        .select(KEY, NUMBER, export_of(F.col("_metadata.file_path")).alias("uri"))
    )
    # One row per month, so this side always fits.
    months_of = spark.createDataFrame(places, "uri string, suffix string")
    placed = rows.join(F.broadcast(months_of), "uri")
    return placed.select("suffix", *clean_return(F.col(KEY), F.col(NUMBER)))


def clean_return(key, number):
    return (
        blank_to_null(trim_blanks(strip_cr(key))).alias(KEY),
        blank_to_null(strip_semicolons(trim_blanks(strip_cr(number)))).alias(NUMBER),
    )


def as_history(table: DataFrame) -> DataFrame:
    """A table of yearly locations in the engine's types; the key's casing does not matter."""
    return table.select(
        F.col(KEY).cast("string").alias(KEY),
        F.col("komnrhjem2").cast("string").alias("komnrhjem2"),
        F.col("bydel2").cast("string").alias("bydel2"),
        F.col("aar").cast("int").alias("aar"),
    )


def empty_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], HISTORY_SCHEMA)


def override_table(spark: SparkSession, rows=LOCATION_OVERRIDES) -> DataFrame:
    return spark.createDataFrame(list(rows), "NPRId string, aar int, komnrhjem2 string")
