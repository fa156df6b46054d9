"""The two runs: ask for run numbers, then deliver. All months and regions in one plan.

Between the two, the request file goes to the registry and comes back with a run number per
person. State is only in the files, so each run stands alone.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postbud import layout
from postbud.functions.predicates import KEY, NUMBER, is_valid_key
from postbud.operators.conform import missing_column_report
from postbud.operators.delivery import deliver
from postbud.operators.geo import keys_missing_municipality, location_fixes, needed_history
from postbud.operators.ids import GROUP, RUN_KEY, key_profile, request_ids
from postbud.operators.keys import (
    counts_of,
    gates_of,
    key_table,
    lookup_of,
    metrics_of,
    totals,
    unmapped_keys,
    without_year,
)
from postbud.operators.quality import enforce
from postbud.options import DeliveryOptions
from postbud.session import run_folder, stage
from postbud.sinks.files import Written, read_table, write_files, write_table
from postbud.sources.exports import GATE, Reports, load_reports
from postbud.sources.tables import as_history, empty_history, missing_returns, override_table, read_returns

log = logging.getLogger("postbud")

# Columns a run brings about itself, so an export need not have them.
FILLED_LATER = (NUMBER, "KommuneNr", "BydelNr", "År")


@dataclass(frozen=True)
class RunResult:
    """What a run left behind: its status, files by kind, warnings and counts."""

    status: str
    files: dict[str, dict[tuple[str, ...], str]] = field(default_factory=dict)
    warnings: tuple = ()
    metrics: DataFrame | None = None


def step1(spark: SparkSession, options: DeliveryOptions) -> RunResult:
    """Write one request per month with the distinct valid keys of all regions."""
    with run_folder(spark):
        return _step1(spark, options)


def _step1(spark: SparkSession, options: DeliveryOptions) -> RunResult:
    reports = load_reports(spark, options)
    if reports is None:
        log.warning("no input for %s", ", ".join(options.suffixes))
        return RunResult("no_inputs")
    requests = stage(request_ids(reports.rows), "requests")
    return RunResult("step1_done", {"request": _write_requests(requests, reports, options).paths})


def step2(
    spark: SparkSession,
    options: DeliveryOptions,
    history: DataFrame | None = None,
    overrides: DataFrame | None = None,
) -> RunResult:
    """Check the returned numbers and write one delivery per region and month.

    ``history`` is the table of yearly locations, any DataFrame with the key, ``komnrhjem2``,
    ``bydel2`` and ``aar``. ``overrides`` is a table of corrections (key, ``aar``, ``komnrhjem2``) in place of those
    in the options. Tables staged on the way hold keys and numbers side by side, so they
    are deleted at the end, also after a failed check.
    """
    with run_folder(spark):
        return _step2(spark, options, history, overrides)


def _step2(
    spark: SparkSession, options: DeliveryOptions, history: DataFrame | None, overrides: DataFrame | None
) -> RunResult:
    reports = load_reports(spark, options)
    if reports is None:
        log.warning("no input for %s", ", ".join(options.suffixes))
        return RunResult("no_inputs")
    months = _months(reports)

    # One narrow aggregate answers every question that comes before the wide join.
    profile = stage(key_profile(reports.rows, options.integer_columns), "profile")
    requests = profile.where(is_valid_key(F.col(KEY))).select(*RUN_KEY).distinct()
    files = {
        "request": _write_requests(requests.withColumn("Dummy", F.lit("")), reports, options).paths
    }

    report_only = "missing_returns" in options.warn_only
    lost = [GATE("missing_returns", s, None, 1, None) for s in missing_returns(spark, options.app_dir, months)]
    warnings = _warn([*reports.gates, *(lost if report_only else [])])
    id_map = stage(read_returns(spark, options.app_dir, months, skip_missing=report_only), "numbers")
    fixes = _fixes(spark, options, profile, history, overrides)

    # Profile, numbers and locations are joined once, and everything below is told from there.
    keys = stage(key_table(profile, id_map, fixes), "keys")
    counted = stage(totals(keys, options.integer_columns), "totals")
    failed = gates_of(counted, keys).collect()
    unmapped = {(r["suffix"],) for r in failed if r["gate"] == "unmapped"}
    if unmapped:
        files["unmapped"] = write_files(
            unmapped_keys(keys).where(F.col("suffix").isin([s for s, in unmapped])),
            ["suffix"], layout.UNMAPPED_NAME, options.out_dir, sep=",",
            max_rows=options.max_rows_per_file, one_file=options.one_file, sort_by=[KEY],
        ).paths
    warnings += _warn(enforce(failed, _stopping(options)))

    groups = spark.createDataFrame(sorted(reports.present), "region string, suffix string")
    counts = stage(groups.join(counts_of(counted), GROUP, "left").na.fill(0), "counts")
    sizes = {(r["region"], r["suffix"]): r["rows"] for r in counts.collect()}
    delivery = deliver(
        reports.rows, id_map, fixes, options,
        lookup=lookup_of(keys, keep_unnumbered="enr" in reports.rows.columns), no_year=without_year(counted),
    )
    files["delivery"] = _write_deliveries(spark, delivery, sizes, options).paths

    # One row per month, region and count, which outlives the staged tables.
    metrics = metrics_of(counted, groups)
    metrics = spark.createDataFrame(metrics.collect(), metrics.schema)
    files.update(_write_checks(spark, reports, counts, metrics, options))
    return RunResult("delivered", files, tuple(warnings), metrics)


def _stopping(options: DeliveryOptions) -> list[str]:
    stopping = ["map_empty", "map_duplicates"]
    stopping += ["unmapped"] if options.strict_lopenr else []
    stopping += ["mojibake_out"] if options.fail_on_mojibake_out else []
    return [gate for gate in stopping if gate not in options.warn_only]


def _fixes(
    spark: SparkSession,
    options: DeliveryOptions,
    profile: DataFrame,
    history: DataFrame | None,
    overrides: DataFrame | None,
) -> DataFrame | None:
    """The staged locations of those who lack one, or None if they are not to be filled."""
    if not options.fill_missing_kommune:
        return None
    needed = stage(keys_missing_municipality(profile), "needed")
    yearly = empty_history(spark) if history is None else as_history(history)
    if overrides is None and options.overrides:
        overrides = override_table(spark, options.overrides)
    yearly = needed_history(yearly, needed.select(KEY).distinct())
    return stage(location_fixes(yearly, needed, overrides), "locations")


def run(
    spark: SparkSession,
    step: str,
    options: DeliveryOptions,
    history: DataFrame | None = None,
    overrides: DataFrame | None = None,
) -> RunResult:
    if step.upper() == "STEP1":
        return step1(spark, options)
    if step.upper() == "STEP2":
        return step2(spark, options, history, overrides)
    raise ValueError("step must be STEP1 or STEP2")


def _months(reports: Reports) -> list[str]:
    return sorted({suffix for _, suffix in reports.present})


def _write_requests(requests: DataFrame, reports: Reports, options: DeliveryOptions) -> Written:
    sizes = {(month,): 0 for month in _months(reports)}
    rows = requests.groupBy("suffix").agg(F.count("*").alias("n")).collect()
    sizes.update({(r["suffix"],): r["n"] for r in rows})
    return write_files(
        requests, ["suffix"], layout.REQUEST_NAME, options.app_dir,
        sizes=sizes, max_rows=options.max_rows_per_file, one_file=options.one_file, sort_by=[KEY],
    )


def _write_deliveries(
    spark: SparkSession, delivery: DataFrame, sizes: dict[tuple[str, str], int], options: DeliveryOptions
) -> Written:
    """Write the deliveries once, to their table, and the text files from there.

    The table stands once its rows are as many as were counted before; the text is written from it after that.
    Rows of a region and month lie together in the table, so the text takes no further shuffle.
    """
    by_month = {(suffix, region): n for (region, suffix), n in sizes.items()}
    filled = [g for g, n in by_month.items() if n]
    write_table(delivery, options.delivery_table, GROUP, [g for g, n in by_month.items() if not n], by_month)
    return write_files(
        read_table(spark, options.delivery_table, delivery.schema, GROUP, filled),
        ["region", "suffix"], layout.DELIVERY_NAME, options.out_dir,
        sizes=sizes, bom=True, max_rows=options.max_rows_per_file, one_file=options.one_file, clustered=True,
    )


def _write_checks(
    spark: SparkSession,
    reports: Reports,
    counts: DataFrame,
    metrics: DataFrame,
    options: DeliveryOptions,
) -> dict[str, dict[tuple[str, ...], str]]:
    """Small tables for the people who look after the run."""
    wanted = [c for c in options.columns if c not in FILLED_LATER]
    absent = missing_column_report(spark, reports.present, wanted)
    summary = counts.select(F.col("region").alias("RHF"), "suffix", "rows", "missing_kommune")
    tables = {
        "missing_columns": (absent, ["region", "suffix"], layout.MISSING_COLUMNS_NAME),
        "summary": (summary, ["suffix"], layout.SUMMARY_NAME),
        "metrics": (metrics, ["suffix"], layout.METRICS_NAME),
    }

    def write(kind: str) -> dict[tuple[str, ...], str]:
        df, group, name = tables[kind]
        # The place is part of the content here, so it is grouped by a copy. There is a row per
        # region, month and column or count at most, so these are always files.
        return write_files(
            df.select("*", *[F.col(g).alias(f"_{g}") for g in group]),
            [f"_{g}" for g in group],
            name.replace("{region}", "{_region}").replace("{suffix}", "{_suffix}"),
            options.out_dir, sep=",", sort_by=df.columns, one_file=True,
        ).paths

    with ThreadPoolExecutor(len(tables)) as pool:
        return dict(zip(tables, pool.map(write, tables)))


def _warn(failures: Iterable) -> list:
    failures = list(failures)
    for r in failures:
        log.warning("%s %s %s: %s", r["gate"], r["suffix"], r["region"] or "", r["failures"])
    return failures
