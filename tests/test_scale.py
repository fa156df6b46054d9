"""What the plans must look like to hold on data far larger than these tables."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from postbud.layout import DELIVERY_COLUMNS
from postbud.operators.delivery import deliver, key_lookup
from postbud.operators import geo
from postbud.operators.geo import (
    ids_missing_municipality,
    keys_missing_municipality,
    latest_location,
    location_fixes,
    needed_history,
)
from postbud.operators.ids import attach_numbers, first_examples, key_profile, request_ids
from postbud.operators.keys import gates_of, key_table, metrics_of, totals
from postbud.options import DeliveryOptions
from postbud.plans.runs import _write_deliveries
from postbud.session import stage

OPTIONS = DeliveryOptions()
SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def conf(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_SKEW}
    for k, v in SMALL_SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture
def hot(spark):
    """A report in which one key holds a third of the rows and one region most of them."""
    key = F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 20000).cast("string"))
    report = spark.range(0, 120_000, 1, 8).select(
        F.lit("des25").alias("suffix"),
        F.when(F.col("id") % 10 == 0, "HV").otherwise("HSØ").alias("region"),
        key.alias("NPRId"),
        F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise("0301").alias("KommuneNr"),
        F.lit("").alias("BydelNr"),
        F.sha2(F.col("id").cast("string"), 256).alias("Pakkeforløp"),
        F.lit("").alias("År"),
        F.lit("01.12.2025").alias("StartDato"),
    )
    people = spark.range(0, 20_000).select(F.col("id").cast("string").alias("NPRId"))
    id_map = people.select(F.lit("des25").alias("suffix"), "NPRId", F.concat(F.lit("n"), "NPRId").alias("lopenr"))
    history = people.select("NPRId", F.lit("0301").alias("komnrhjem2"), F.lit("1").alias("bydel2"), F.lit(2020).alias("aar"))
    return stage(report, "report"), stage(id_map, "map"), stage(history, "history")


def test_table_and_text_execute_the_join_once(spark, conf, hot, tmp_path):
    report, id_map, _ = hot
    scans = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(value):
        scans.add(1)
        return value

    counted = deliver(report, id_map, None, OPTIONS).withColumn("OF1", seen("OF1"))
    sizes = {("HSØ", "des25"): 108_000, ("HV", "des25"): 12_000, ("HMN", "des25"): 0}
    options = replace(OPTIONS, out_dir=str(tmp_path), max_rows_per_file=10_000)
    written = _write_deliveries(spark, counted, sizes, options)
    assert written.rows == scans.value == 120_000
    for (region, suffix), n in sizes.items():
        parts = list((tmp_path / f"Utlevering_{region}_{suffix}.csv").glob("part-*.csv"))
        rows = [len(p.read_text(encoding="utf-8").splitlines()) - 1 for p in parts]
        assert sum(rows) == n and max(rows) <= 10_000
        assert all(p.read_text(encoding="utf-8").startswith("\ufeff" + ";".join(DELIVERY_COLUMNS)) for p in parts)


def executed(df):
    """The plan as it ran, after an action that needs every column."""
    df = df.select(F.sum(F.xxhash64(*df.columns).try_cast("double")).alias("x"))
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_key_is_split_in_the_wide_join(spark, conf, hot):
    report, id_map, history = hot
    fixes = stage(location_fixes(history, ids_missing_municipality(report)), "fixes")
    lookup = stage(key_lookup(id_map, fixes), "lookup")
    done = deliver(report, id_map, fixes, OPTIONS, stage(key_profile(report), "profile"), lookup=lookup)
    plan = executed(done)
    assert "SortMergeJoin(skew=true)" in plan
    assert done.count() == 120_000


def test_hot_key_is_split_in_a_plain_join(spark, conf, hot):
    report, id_map, _ = hot
    numbered = attach_numbers(report, id_map)
    assert "SortMergeJoin(skew=true)" in executed(numbered)


def test_the_wide_report_is_shuffled_once(spark, conf, hot):
    report, id_map, history = hot
    fixes = stage(location_fixes(history, ids_missing_municipality(report)), "fixes")
    lookup = stage(key_lookup(id_map, fixes), "lookup")
    done = deliver(report, id_map, fixes, OPTIONS, stage(key_profile(report), "profile"), lookup=lookup)
    plan = executed(done)
    with_text = [line for line in plan.splitlines() if "FileScan" in line and "Pakkeforløp" in line]
    assert len(with_text) == 1
    # One exchange each for the report and the lookup; three for the groups without a year.
    assert plan.count("Exchange hashpartitioning") == 5
    assert "IsNotNull(NPRId)" in with_text[0]


def test_keys_are_combined_before_the_shuffle(spark, conf, hot):
    report, _, history = hot
    for df in (request_ids(report), key_profile(report), latest_location(history)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        above, below = plan.split("Exchange", 1)
        assert "Aggregate" in above and "Aggregate" in below


def test_gates_and_metrics_take_three_shuffles(spark, conf, hot):
    report, id_map, history = hot
    profile = stage(key_profile(report), "profile")
    fixes = stage(location_fixes(history, keys_missing_municipality(profile)), "fixes")
    keys = stage(key_table(profile, id_map, fixes), "keys")
    counted = stage(totals(keys), "totals")
    for df, most in ((key_table(profile, id_map, fixes), 1), (totals(keys), 1), (gates_of(counted, keys), 2), (metrics_of(counted), 0)):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hash") <= most
    above, below = totals(keys)._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)
    assert "HashAggregate" in above and "HashAggregate" in below
    assert "WindowGroupLimit" in gates_of(counted, keys)._jdf.queryExecution().executedPlan().toString()


def test_needed_keys_reach_the_scan_of_the_history(spark, conf, hot, monkeypatch):
    _, _, history = hot

    def scanned(n):
        keys = stage(spark.range(100, 100 + n).selectExpr("CAST(id AS STRING) AS NPRId"), "few")
        found = needed_history(history, keys)
        assert found.count() == n
        return found._jdf.queryExecution().executedPlan().toString()

    assert "In(NPRId, [" in scanned(5)
    monkeypatch.setattr(geo, "FEW_KEYS", 10)
    plan = scanned(50)
    assert "GreaterThanOrEqual(NPRId,100)" in plan and "LessThanOrEqual(NPRId,149)" in plan and "LeftSemi" in plan
    # Sorted by key, as a large history would be, only the row groups with needed keys are read.
    rows = spark.range(0, 200_000).selectExpr("lpad(id, 8, '0') AS NPRId", "'0301' AS komnrhjem2", "'1' AS bydel2", "2020 AS aar")
    table = stage(rows.repartitionByRange(64, "NPRId").sortWithinPartitions("NPRId"), "sorted")
    needed = stage(spark.range(70_000, 70_100).selectExpr("lpad(id, 8, '0') AS NPRId"), "needed")
    read = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda v: (read.add(1), v)[1], "string")
    cut = needed_history(table, needed)
    scan = [f for f in cut._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in f][0]
    assert "PushedFilters: [IsNotNull(NPRId), GreaterThanOrEqual(NPRId,00070000)" in scan or "00070000" in scan
    assert cut.count() == 100
    in_range = table.where(F.col("NPRId").between("00070000", "00070099")).select(seen("NPRId").alias("k"))
    in_range.agg(F.max("k")).collect()
    assert read.value < 200_000 / 10


def test_profile_reads_only_its_columns(hot):
    report, _, _ = hot
    plan = request_ids(report)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<suffix:string,NPRId:string>" in plan


def test_examples_are_cut_before_the_shuffle(spark, conf, hot):
    report, id_map, _ = hot
    plan = first_examples(id_map)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning", 1)[1]


def test_only_tables_of_one_row_per_place_are_broadcast(spark, conf, hot):
    report, id_map, history = hot
    fixes = location_fixes(history, ids_missing_municipality(report))
    done = deliver(report, id_map, fixes, OPTIONS)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 1
    assert "keys=[suffix" in plan.split("BroadcastExchange", 1)[1]
