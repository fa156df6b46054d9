"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postbud.functions.dates import month_suffix, parse_any_date
from postbud.functions.numbers import to_integer
from postbud.functions.predicates import is_blank, is_missing
from postbud.functions.text import garble, header_key, repair_mojibake
from postbud.layout import DELIVERY_COLUMNS
from postbud.operators.conform import (
    conform,
    drop_column_at_if_empty,
    drop_empty_columns,
    output_shape,
    union_regions,
)
from postbud.operators.delivery import deliver
from postbud.operators.geo import (
    apply_overrides,
    fill_location,
    ids_missing_municipality,
    keys_missing_municipality,
    latest_location,
    location_fixes,
)
from postbud.operators.ids import (
    attach_numbers,
    duplicate_keys,
    first_examples,
    key_profile,
    request_ids,
    unmapped_ids,
)
from postbud.operators.keys import gates_of, key_table, lookup_of, metrics_of, totals, without_year
from postbud.operators.quality import (
    cast_loss,
    delivery_counts,
    empty_column_report,
    gate_table,
    id_profile,
    missing_by_group,
    mojibake_by_column,
    month_control,
    qc_summary,
)
from postbud.options import DeliveryOptions
from postbud.plans.runs import step1, step2
from postbud.queries import standins as given
from postbud.session import scratch_path, stage
from postbud.sinks.files import read_table, write_files, write_table
from postbud.sources.exports import load_reports
from postbud.sources.files import choose_inputs, profile
from postbud.sources.tables import as_history, clean_return, read_returns

OPTIONS = DeliveryOptions(months=given.RUN_MONTHS)
TYPED = replace(OPTIONS, integer_columns=("institusjonId", "lopenr"), missing_token=None)

Query = Callable[[SparkSession, str], DataFrame]


def fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = ids_missing_municipality(given.report(spark, sf_dir))
    return location_fixes(given.history(spark, sf_dir), needed, given.overrides(spark, sf_dir))


def profiled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The staged key profile, and the fixes for whom it shows without a municipality."""
    profile = stage(key_profile(given.report(spark, sf_dir), ["institusjonId"]), "profile")
    located = location_fixes(
        given.history(spark, sf_dir), keys_missing_municipality(profile), given.overrides(spark, sf_dir)
    )
    return profile, located


def keyed(spark: SparkSession, sf_dir: str, columns=("institusjonId",)) -> tuple[DataFrame, DataFrame]:
    """The staged key table and what it adds up to, as a run has them."""
    profile, located = profiled(spark, sf_dir)
    keys = stage(key_table(profile, given.id_map(spark, sf_dir), located), "keys")
    return keys, stage(totals(keys, columns), "totals")


def delivered(spark: SparkSession, sf_dir: str, options=OPTIONS, keep=("rad", "region", "suffix")) -> DataFrame:
    keys, counted = keyed(spark, sf_dir)
    # Numbers and locations come with the lookup.
    return deliver(
        given.report(spark, sf_dir), keys, fixes=keys, options=options, keep=keep,
        lookup=lookup_of(keys), no_year=without_year(counted),
    )


# --- keys and numbers ------------------------------------------------------------------------


def q_request_ids(spark, sf_dir):
    return request_ids(given.report(spark, sf_dir))


def q_key_profile(spark, sf_dir):
    return key_profile(given.report(spark, sf_dir), ["institusjonId"])


def q_id_profile(spark, sf_dir):
    return id_profile(key_profile(given.report(spark, sf_dir)))


def q_unmapped_ids(spark, sf_dir):
    return unmapped_ids(given.report(spark, sf_dir), given.id_map(spark, sf_dir))


def q_map_duplicates(spark, sf_dir):
    return duplicate_keys(given.id_map_with_repeats(spark, sf_dir))


def q_duplicate_examples(spark, sf_dir):
    return first_examples(duplicate_keys(given.id_map_with_repeats(spark, sf_dir)))


def q_numbered_rows(spark, sf_dir):
    rows = attach_numbers(given.report(spark, sf_dir), given.id_map(spark, sf_dir))
    return rows.select("rad", "region", "suffix", "NPRId", "lopenr")


def q_deliverable_by_region(spark, sf_dir):
    rows = attach_numbers(given.report(spark, sf_dir), given.id_map(spark, sf_dir))
    return rows.groupBy("region").agg(
        F.count("*").alias("n_rows"),
        F.count_if(is_missing(F.col("KommuneNr"))).alias("missing_kommune"),
    )


def q_return_cells(spark, sf_dir):
    people = given.table(spark, sf_dir, "customer")
    key = F.concat(F.lit("  "), F.col("c_name"), F.lit("\t\r"))
    number = F.when(F.col("c_acctbal") < 0, " \r").otherwise(
        F.concat(F.lit(" "), given.text("c_custkey"), F.lit(";\r "))
    )
    return people.select(*clean_return(key, number))


# --- location --------------------------------------------------------------------------------


def q_ids_missing_municipality(spark, sf_dir):
    return ids_missing_municipality(given.report(spark, sf_dir))


def q_geo_latest(spark, sf_dir):
    return latest_location(given.history(spark, sf_dir))


def q_geo_history_typed(spark, sf_dir):
    raw = given.history(spark, sf_dir)
    return as_history(raw.select(F.col("NPRId").alias("NPRid"), F.col("aar").cast("long"), "komnrhjem2", "bydel2"))


def q_geo_overridden(spark, sf_dir):
    return apply_overrides(latest_location(given.history(spark, sf_dir)), given.overrides(spark, sf_dir))


def q_geo_fixes(spark, sf_dir):
    return fixes(spark, sf_dir)


def _filled(spark, sf_dir, mode):
    return fill_location(given.report(spark, sf_dir), fixes(spark, sf_dir), mode)


def q_kommune_filled(spark, sf_dir):
    return _filled(spark, sf_dir, "original").select("rad", "KommuneNr")


def q_bydel_original(spark, sf_dir):
    return _filled(spark, sf_dir, "original").select("rad", "BydelNr")


def q_bydel_filled(spark, sf_dir):
    return _filled(spark, sf_dir, "filled").select("rad", "BydelNr")


# --- delivery --------------------------------------------------------------------------------


def q_delivery_rows(spark, sf_dir):
    return delivered(spark, sf_dir)


def q_delivery_strict_types(spark, sf_dir):
    return delivered(spark, sf_dir, TYPED)


def q_delivery_without_fill(spark, sf_dir):
    return deliver(
        given.report(spark, sf_dir), given.id_map(spark, sf_dir), None, OPTIONS, keep=("rad",)
    ).select("rad", "lopenr", "KommuneNr", "BydelNr")


def q_year_backfill(spark, sf_dir):
    return delivered(spark, sf_dir).select("rad", "År")


def q_number_rescue(spark, sf_dir):
    report = given.report(spark, sf_dir).withColumn(
        "enr", F.when(F.col("institusjonId") == "ukjent", F.concat(F.lit("E"), given.text("rad"))).otherwise("")
    )
    return deliver(
        report, given.id_map(spark, sf_dir), fixes(spark, sf_dir), OPTIONS, keep=("rad",)
    ).select("rad", "lopenr", "KommuneNr")


def q_output_shape(spark, sf_dir):
    return output_shape(given.report(spark, sf_dir), OPTIONS, keep=["rad"])


def q_delivery_table(spark, sf_dir):
    path = scratch_path(spark, "deliveries")
    rows = delivered(spark, sf_dir, keep=("region", "suffix"))
    write_table(rows, path)
    back = read_table(spark, path, rows.schema)
    return back.groupBy("region", "suffix").agg(
        F.count("*").alias("n_rows"), F.count_distinct("lopenr").alias("n_people")
    )


# --- quality ---------------------------------------------------------------------------------


def q_qc_summary(spark, sf_dir):
    return qc_summary(delivered(spark, sf_dir))


def q_delivery_counts(spark, sf_dir):
    profile, located = profiled(spark, sf_dir)
    return delivery_counts(profile, given.id_map(spark, sf_dir), located)


def q_month_control(spark, sf_dir):
    return month_control(delivered(spark, sf_dir), 1998)


def q_cast_loss(spark, sf_dir):
    rows = attach_numbers(given.report(spark, sf_dir), given.id_map(spark, sf_dir))
    return cast_loss(rows, ["institusjonId", "lopenr"])


def q_gates(spark, sf_dir):
    profile, located = profiled(spark, sf_dir)
    keys = stage(key_table(profile, given.id_map_with_repeats(spark, sf_dir), located), "keys")
    return gates_of(stage(totals(keys), "totals"), keys)


def q_gates_of_faulty_input(spark, sf_dir):
    """No answers for December, and text that was decoded wrongly on its way."""
    report = given.report(spark, sf_dir).withColumn("Pakkeforløp", garble(F.col("Pakkeforløp")))
    answers = given.id_map(spark, sf_dir).withColumn("lopenr", F.when(F.col("suffix") != "des25", F.col("lopenr")))
    known = answers.where("NOT (suffix = 'des25' AND lopenr IS NULL)")
    keys = stage(key_table(stage(key_profile(report), "profile"), known), "keys")
    return gates_of(stage(totals(keys), "totals"), keys)


def q_run_metrics(spark, sf_dir):
    _, counted = keyed(spark, sf_dir, ())
    return metrics_of(counted)


def q_empty_columns(spark, sf_dir):
    return empty_column_report(given.report(spark, sf_dir))


def q_missing_layout_columns(spark, sf_dir):
    return missing_by_group(given.report(spark, sf_dir), DELIVERY_COLUMNS)


# --- text, dates, numbers --------------------------------------------------------------------


def q_mojibake_repair(spark, sf_dir):
    documents = given.table(spark, sf_dir, "documents")
    return documents.select("doc_id", repair_mojibake(garble(F.col("text"))).alias("text"))


def q_mojibake_count(spark, sf_dir):
    documents = given.table(spark, sf_dir, "documents")
    garbled = documents.select(garble(F.col("text")).alias("text"), "source", "lang")
    return mojibake_by_column(garbled)


def q_header_keys(spark, sf_dir):
    documents = given.table(spark, sf_dir, "documents")
    return documents.select("doc_id", header_key(F.col("text")).alias("header_key"))


def q_parse_dates(spark, sf_dir):
    lines = given.table(spark, sf_dir, "lineitem")
    day, line = F.col("l_shipdate"), F.col("l_linenumber")
    written = given.cases(
        (line == 1, F.date_format(day, "yyyyMMdd")),
        (line == 2, F.date_format(day, "ddMMyyyy")),
        (line == 3, F.date_format(day, "yyyy-M-d")),
        (line == 4, F.date_format(day, "d.M.yyyy")),
        (line == 5, F.date_format(day, "yyyy/MM/dd HH:mm:ss")),
        (line == 6, F.date_format(day, " dd-MM-yyyy 23:59:59")),
        otherwise=F.date_format(day, "'uke 'D"),
    )
    return lines.select("l_orderkey", "l_linenumber", parse_any_date(written).alias("parsed"))


def q_month_suffix_counts(spark, sf_dir):
    lines = given.table(spark, sf_dir, "lineitem")
    return lines.groupBy(month_suffix(F.col("l_shipdate")).alias("suffix")).agg(F.count("*").alias("n_rows"))


def q_integer_cast(spark, sf_dir):
    events = given.table(spark, sf_dir, "events")
    value = F.col("value")
    written = given.cases(
        (F.col("event_type") == "error", F.col("props")),
        (F.col("event_type") == "click", F.concat(F.lit(" "), given.text(value), F.lit("\t"))),
        (F.col("event_type") == "view", given.text((value * 100000000).cast("long"))),
        otherwise=F.concat(F.lit("-"), given.text(value)),
    )
    return events.select("event_id", to_integer(written).alias("as_integer"))


# --- shaping ---------------------------------------------------------------------------------


def q_union_regions(spark, sf_dir):
    report = given.report(spark, sf_dir)
    columns = {"HSØ": ["KommuneNr"], "HV": ["BydelNr", "institusjon"], "HMN": ["institusjon", "KommuneNr"]}
    return union_regions(
        report.where(F.col("region") == region).select("rad", "NPRId", *names)
        for region, names in columns.items()
    )


def q_alias_conform(spark, sf_dir):
    people = given.table(spark, sf_dir, "customer")
    export = people.select(
        given.text("c_custkey").alias(" NPR-Id "),
        F.col("c_name").alias("Institusjon Navn"),
        given.text("c_nationkey").alias("Kommune"),
        given.text("c_acctbal").alias("Føds els-Dato"),
        F.col("c_mktsegment").alias("textbox74"),
        F.col("c_mktsegment").alias("Egen kolonne"),
    )
    return conform(export, OPTIONS)


# --- files -----------------------------------------------------------------------------------


def q_newest_inputs(spark, sf_dir):
    report = given.report(spark, sf_dir)
    orders = given.table(spark, sf_dir, "orders")
    listing = (
        report.select("rad", "region", "suffix")
        .join(orders, F.col("rad") == F.col("o_orderkey"))
        .select(
            F.concat(
                F.lit("/in/"), F.col("region"), F.lit("/Uttrekk "), given.text("rad"), F.lit(" rhf_"),
                F.col("region"),
                F.when(F.col("o_orderstatus") == "O", "").otherwise(F.concat(F.lit("_"), F.col("suffix"))),
                F.when(F.col("o_orderpriority") == "5-LOW", ".CSV").otherwise(".csv"),
            ).alias("path"),
            F.col("o_orderdate").alias("modified"),
            F.col("rad").alias("length"),
        )
    )
    listing = listing.withColumn("uri", F.col("path"))
    return choose_inputs(listing, replace(OPTIONS, strict_input=False)).select(
        "region", "suffix", "path", "length"
    )


def q_file_profile(spark, sf_dir):
    options = given.write_exports(spark, sf_dir)
    folders = [f"{options.base_dir}/{region}" for region in options.regions]
    facts = profile(spark, folders, options)
    place = r"/in/([^/]+)/.*_([a-z]{3}\d\d)\.csv$"
    path = F.url_decode("uri")
    return facts.select(
        F.regexp_extract(path, place, 1).alias("region"), F.regexp_extract(path, place, 2).alias("suffix"),
        "delimiter", "encoding", "n_columns",
    )


def _blank_as_null(df, columns):
    return df.select(
        "region", "suffix", *[F.when(~is_blank(F.col(c)), F.col(c)).alias(c) for c in columns]
    )


def q_read_exports(spark, sf_dir):
    reports = load_reports(spark, given.write_exports(spark, sf_dir))
    return _blank_as_null(reports.rows, given.EXPORT_COLUMNS)


def q_cached_exports(spark, sf_dir):
    options = replace(given.write_exports(spark, sf_dir), cache_dir=scratch_path(spark, "cache"))
    load_reports(spark, options)
    return _blank_as_null(load_reports(spark, options).rows, given.EXPORT_COLUMNS)


def _scratch_options(spark):
    home = scratch_path(spark, "exchange")
    return replace(OPTIONS, base_dir=f"{home}/in", app_dir=f"{home}/app", out_dir=f"{home}/out")


def q_read_returns(spark, sf_dir):
    options = _scratch_options(spark)
    given.write_returns(spark, sf_dir, options)
    return read_returns(spark, options.app_dir, options.suffixes)


def q_csv_roundtrip(spark, sf_dir):
    documents = given.table(spark, sf_dir, "documents").select(
        "lang", given.text("doc_id").alias("doc_id"), "text"
    )
    folder = scratch_path(spark, "texts")
    written = write_files(documents, ["lang"], "{lang}.csv", folder, bom=True)
    return (
        spark.read.schema("doc_id string, text string")
        .options(header=True, sep=";", quote='"', escape='"', multiLine=True)
        .csv(list(written.paths.values()))
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    )


def q_run_requests(spark, sf_dir):
    options = given.write_exports(spark, sf_dir)
    result = step1(spark, options)
    return (
        spark.read.options(header=True, sep=";")
        .csv(list(result.files["request"].values()))
        .select(
            F.regexp_extract(F.col("_metadata.file_path"), r"_([a-z]{3}\d\d)\.csv/", 1).alias("suffix"),
            "NPRId",
        )
    )


def q_run_deliveries(spark, sf_dir):
    options = given.write_exports(spark, sf_dir)
    given.write_returns(spark, sf_dir, options)
    result = step2(spark, options, given.history(spark, sf_dir), given.overrides(spark, sf_dir))
    return given.read_deliveries(spark, result.files["delivery"], DELIVERY_COLUMNS)


def q_run_deliveries_in_parts(spark, sf_dir):
    options = given.write_exports(spark, sf_dir, one_file=False)
    options = replace(options, max_rows_per_file=250)
    given.write_returns(spark, sf_dir, options, one_file=False)
    result = step2(spark, options, given.history(spark, sf_dir), given.overrides(spark, sf_dir))
    return given.read_deliveries(spark, result.files["delivery"], DELIVERY_COLUMNS)


def q_run_deliveries_one_file(spark, sf_dir):
    options = replace(given.write_exports(spark, sf_dir), one_file=True)
    given.write_returns(spark, sf_dir, options)
    result = step2(spark, options, given.history(spark, sf_dir), given.overrides(spark, sf_dir))
    return given.read_deliveries(spark, result.files["delivery"], DELIVERY_COLUMNS)


def q_run_check_files(spark, sf_dir):
    """What a run leaves for those who look after it, read back: unmapped keys, missing columns, summary.

    The mapping lacks everyone of one segment, the location history is empty, and a region has no file for December.
    """
    def without_a_file(rows):
        return rows.where("NOT (region = 'HMN' AND suffix = 'des25')")

    options = replace(given.write_exports(spark, sf_dir, change=without_a_file), strict_input=False)
    given.write_returns(spark, sf_dir, options)
    files = step2(spark, options, given.history(spark, sf_dir).limit(0)).files

    def read(kind, *columns):
        rows = spark.read.options(header=True, sep=",", lineSep="\n").csv(list(files[kind].values()))
        months = F.regexp_extract(F.col("_metadata.file_path"), r"_([a-z]{3}\d\d)\.csv", 1)
        return rows.select(F.lit(kind).alias("kind"), months.alias("suffix"), *[c.alias(n) for n, c in zip(("place", "what"), columns)])

    return (
        read("unmapped", F.lit(None).cast("string"), F.concat_ws(" ", "NPRId", "lopenr"))
        .unionByName(read("missing_columns", F.col("region"), F.col("missing_column")))
        .unionByName(read("summary", F.col("RHF"), F.concat_ws(" ", "rows", "missing_kommune")))
    )


def q_input_gates(spark, sf_dir):
    """Checks that fail while files are read: no file, a column that should be empty, wrong decoding."""
    def faulty(rows):
        rows = rows.where("NOT (region = 'HMN' AND suffix = 'des25')")
        return rows.withColumn("Pakkeforløp", garble(F.col("Pakkeforløp")))

    options = replace(
        given.write_exports(spark, sf_dir, change=faulty), repair_mojibake=False, fail_on_mojibake=True,
        drop_position=1, warn_only=("missing_input", "mojibake_in"),
    )
    return gate_table(spark, load_reports(spark, options).gates)


def q_quoted_line_feeds(spark, sf_dir):
    def two_lines(rows):
        return rows.withColumn("Pakkeforløp", F.replace(F.col("Pakkeforløp"), F.lit("; "), F.lit('"\n;')))

    reports = load_reports(spark, given.write_exports(spark, sf_dir, change=two_lines))
    return reports.rows.select("region", "suffix", "pfInstansId", "Pakkeforløp")


def q_repeated_header(spark, sf_dir):
    reports = load_reports(spark, given.write_exports(spark, sf_dir, change=given.with_repeated_headers))
    return _blank_as_null(reports.rows, given.EXPORT_COLUMNS)


def q_table_columns_dropped(spark, sf_dir):
    """Empty columns of one table, and its third one, which has values and stays."""
    kept, dropped = drop_column_at_if_empty(drop_empty_columns(given.report(spark, sf_dir)), 3)
    return kept.withColumn("third_dropped", F.lit(dropped))


def q_columns_dropped(spark, sf_dir):
    options = replace(given.write_exports(spark, sf_dir), drop_empty_columns=True, drop_position=11)
    present = load_reports(spark, options).rows
    return missing_by_group(present.drop("region"), given.EXPORT_COLUMNS, ["suffix"]).unionByName(
        missing_by_group(present.drop("suffix").withColumnRenamed("region", "suffix"), given.EXPORT_COLUMNS, ["suffix"])
    )


def q_parts_with_unequal_headers(spark, sf_dir):
    reports = load_reports(spark, given.write_unequal_parts(spark, sf_dir))
    return _blank_as_null(reports.rows, given.EXPORT_COLUMNS)


def q_bydel_filled_from_files(spark, sf_dir):
    reports = load_reports(spark, given.write_exports(spark, sf_dir))
    return fill_location(reports.rows, fixes(spark, sf_dir), "filled").select("pfInstansId", "BydelNr")


def queries() -> dict[str, Query]:
    return {
        name.removeprefix("q_"): function for name, function in globals().items() if name.startswith("q_")
    }
