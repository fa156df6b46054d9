"""Report, mapping, history and overrides made from the given tables, whole.

Orders stand for report rows, customers for people, nations for institutions. The untidy
spellings of real exports are put in by rules on the row's own values.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postbud.layout import DELIVERY_NAME, EXPORT_NAME, MONTHS, RETURN_NAME
from postbud.options import DeliveryOptions
from postbud.session import scratch_path, stage
from postbud.sinks.files import group_sizes, write_files

YEAR = 2025
RUN_MONTHS = tuple(f"{YEAR}-{m:02d}-01" for m in range(1, 13))
SUFFIXES = DeliveryOptions(months=RUN_MONTHS).suffixes

# Columns of the stand-in that an export brings, so not the row number or its place.
EXPORT_COLUMNS = (
    "NPRId", "institusjonId", "institusjon", "Fagenhet", "KommuneNr", "BydelNr", "pfInstansId",
    "Pakkeforløp", "År", "StartDato", "OF1", "OF4", "Overf",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def month_of_run(c: Column) -> Column:
    return F.concat(F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(c)), F.lit(str(YEAR % 100)))


def cases(*pairs: tuple[Column, object], otherwise=None) -> Column:
    result = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    for condition, value in reversed(pairs):
        result = F.when(condition, value).otherwise(result)
    return result


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    rows = orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    row, person, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    nation, continent, urgency = F.col("n_nationkey"), F.col("n_regionkey"), F.col("o_orderpriority")
    return rows.select(
        row.alias("rad"),
        month_of_run(day).alias("suffix"),
        cases(
            (continent.isin(0, 3), "HSØ"), (continent.isin(1, 4), "HV"), otherwise="HMN"
        ).alias("region"),
        cases(
            (row % 101 == 0, "NULL"), (row % 103 == 0, ""), (row % 107 == 0, "NPRId"),
            (row % 109 == 0, F.lit(None)),
            otherwise=text(person),
        ).alias("NPRId"),
        cases(
            (row % 5 == 0, F.lit(None)), (row % 7 == 0, ""), (row % 11 == 0, "NULL"),
            otherwise=F.lpad(text(person % 40), 4, "0"),
        ).alias("KommuneNr"),
        cases((row % 4 == 0, text(person % 9)), (row % 4 == 1, "")).alias("BydelNr"),
        F.when(F.col("o_totalprice") < 10000, "ukjent")
        .otherwise(F.date_format(day, "dd.MM.yyyy"))
        .alias("StartDato"),
        cases(
            (continent == 2, ""), (urgency == "5-LOW", F.lit(None)), otherwise=text(F.year(day))
        ).alias("År"),
        cases(
            (urgency == "1-URGENT", F.concat(F.lit(" "), text(nation), F.lit(" "))),
            (urgency == "2-HIGH", F.concat(text(nation), F.lit(".7"))),
            (urgency == "3-MEDIUM", text(nation)),
            (urgency == "4-NOT SPECIFIED", "ukjent"),
            otherwise="",
        ).alias("institusjonId"),
        F.col("n_name").alias("institusjon"),
        F.col("c_mktsegment").alias("Fagenhet"),
        F.concat(F.lower("c_mktsegment"), F.lit(" løp; "), F.col("o_orderstatus")).alias("Pakkeforløp"),
        F.concat(F.lit("P"), text(row)).alias("pfInstansId"),
        F.col("o_orderstatus").alias("OF1"),
        F.lit(None).cast("string").alias("OF4"),
        F.lit("").alias("Overf"),
    )


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run number by person; people in debt came back without one, those just out of it as unknown."""
    balance, person = F.col("c_acctbal"), F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        text(person).alias("NPRId"),
        cases((balance < 0, F.lit(None)), (balance < 300, "NULL"), otherwise=text(person * 7 + 1000)).alias("lopenr"),
        "c_mktsegment",
    )


def id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run number by month and person for whoever has an order in that month."""
    asked = (
        table(spark, sf_dir, "orders")
        .select(month_of_run(F.col("o_orderdate")).alias("suffix"), text("o_custkey").alias("NPRId"))
        .distinct()
    )
    return asked.join(numbers(spark, sf_dir), "NPRId").select("suffix", "NPRId", "lopenr")


def id_map_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping with the people of one segment answered twice."""
    once = id_map(spark, sf_dir)
    twice = numbers(spark, sf_dir).where(F.col("c_mktsegment") == "BUILDING").select("NPRId")
    return once.unionByName(once.join(twice, "NPRId", "left_semi").select(*once.columns))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly locations of people with an order; that of an unfinished one is not known."""
    person, year = F.col("o_custkey"), F.year("o_orderdate")
    moved = F.when(person % 3 == 0, year).otherwise(0)
    return (
        table(spark, sf_dir, "orders")
        .select(
            text(person).alias("NPRId"),
            year.alias("aar"),
            F.when(F.col("o_orderstatus") == "F", F.lpad(text((person + moved) % 40), 4, "0")).alias("komnrhjem2"),
            text(person % 9 + 1).alias("bydel2"),
        )
        .distinct()
    )


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A correction for one segment that holds for people last seen in 2000."""
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") == "MACHINERY")
        .select(
            text("c_custkey").alias("NPRId"), F.lit(2000).alias("aar"), F.lit("9999").alias("komnrhjem2")
        )
    )


# How each region writes its exports: separator, encoding, headers that differ.
HABITS = {
    "HSØ": (";", "UTF-8", {"KommuneNr": "Kommune", "Fagenhet": "Enhet navn", "År": "Start-år"}),
    "HV": (",", "UTF-8", {"NPRId": "npr id", "institusjon": "Institusjon\u00a0Navn"}),
    "HMN": (";", "ISO-8859-1", {"Pakkeforløp": "Pakkeforløp Navn1", "pfInstansId": "PF forløp samlet id1"}),
}


def write_exports(
    spark: SparkSession, sf_dir: str, one_file: bool = True, change=lambda rows: rows
) -> DeliveryOptions:
    """Exports of all rows as the regions would send them; gives the options to read them.

    Rows of a file are in order of ``pfInstansId``, so it is always the same one that stands first.
    """
    home = scratch_path(spark, "exchange")
    rows = stage(change(report(spark, sf_dir)), "report")
    place = EXPORT_NAME.replace(".*", "Uttrekk ").replace("\\", "")
    sizes = group_sizes(rows, ["region", "suffix"])

    def write(region: str) -> None:
        sep, encoding, headers = HABITS[region]
        columns = [F.col(c).alias(headers.get(c, c)) for c in EXPORT_COLUMNS]
        write_files(
            rows.where(F.col("region") == region).select("region", "suffix", *columns),
            ["region", "suffix"], "{region}/" + place, f"{home}/in",
            sizes={g: n for g, n in sizes.items() if g[0] == region},
            sep=sep, encoding=encoding, one_file=one_file, sort_by=[headers.get("pfInstansId", "pfInstansId")],
        )

    with ThreadPoolExecutor(len(HABITS)) as pool:
        list(pool.map(write, HABITS))
    return DeliveryOptions(
        months=RUN_MONTHS, base_dir=f"{home}/in", app_dir=f"{home}/app", out_dir=f"{home}/out"
    )


def write_unequal_parts(spark: SparkSession, sf_dir: str) -> DeliveryOptions:
    """Every export in two parts, the second with its columns the other way round."""
    home = scratch_path(spark, "exchange")
    rows = stage(report(spark, sf_dir), "report")
    place = EXPORT_NAME.replace(".*", "Uttrekk ").replace("\\", "")
    for part, columns in enumerate((EXPORT_COLUMNS, EXPORT_COLUMNS[::-1])):
        write_files(
            rows.where(F.pmod("rad", F.lit(2)) == part).select("region", "suffix", *columns),
            ["region", "suffix"], "{region}/" + place + f"/part-{part}.csv", f"{home}/in", one_file=True,
            sort_by=["pfInstansId"],
        )
    return DeliveryOptions(months=RUN_MONTHS, base_dir=f"{home}/in")


def with_repeated_headers(rows: DataFrame) -> DataFrame:
    """The report with two rows at the top of every export that repeat the word above the keys."""
    top = rows.select("region", "suffix").distinct().withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    return rows.unionByName(
        top.select("region", "suffix", F.lit("NPRId").alias("NPRId"), F.lit("P").alias("pfInstansId")), allowMissingColumns=True
    )


def write_returns(spark: SparkSession, sf_dir: str, options: DeliveryOptions, one_file: bool = True) -> None:
    """The registry's answer for every month, untidy as it comes."""
    answers = stage(id_map(spark, sf_dir), "answers").select(
        "suffix",
        F.concat(F.lit(" "), F.col("NPRId")).alias("NPRId"),
        F.concat(F.col("lopenr"), F.lit("\r")).alias("lopenr"),
    )
    write_files(answers, ["suffix"], RETURN_NAME, options.app_dir, header=False, one_file=one_file)


def read_deliveries(spark: SparkSession, paths: dict, columns: Sequence[str]) -> DataFrame:
    """Delivered files as one table again, with the region and month they are for."""
    name = re.escape(DELIVERY_NAME).replace(r"\{region\}", "(.+)").replace(r"\{suffix\}", "([a-z0-9]+)")
    uri = F.col("_metadata.file_path")
    return (
        spark.read.schema(", ".join(f"`{c}` string" for c in columns))
        .options(header=True, sep=";", quote='"', escape='"', lineSep="\n")
        .csv(sorted(paths.values()))
        .select(
            F.regexp_extract(uri, name, 1).alias("region"),
            F.regexp_extract(uri, name, 2).alias("suffix"),
            *columns,
        )
    )
