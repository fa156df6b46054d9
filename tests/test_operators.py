"""Keys, locations, deliveries and checks on small tables with known answers."""

from dataclasses import replace

import pytest

from postbud.layout import DELIVERY_COLUMNS
from postbud.operators.delivery import deliver
from postbud.operators.geo import (
    apply_overrides,
    fill_location,
    ids_missing_municipality,
    keys_missing_municipality,
    latest_location,
    location_fixes,
)
from postbud.operators.ids import duplicate_keys, first_examples, key_profile, request_ids, unmapped_ids
from postbud.operators.keys import gates_of, key_table, metrics_of, totals
from postbud.operators.quality import (
    GateFailed,
    cast_loss,
    delivery_counts,
    enforce,
    id_profile,
    month_control,
    qc_summary,
)
from postbud.options import DeliveryOptions
from postbud.sources.tables import as_history, empty_history, override_table

OPTIONS = DeliveryOptions(months=("2025-12-01", "2026-01-01"))
REPORT = "region string, suffix string, NPRId string, KommuneNr string, BydelNr string, `År` string, StartDato string, `Pakkeforløp` string"


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


@pytest.fixture
def report(spark):
    rows = [
        ("HV", "des25", "1", None, "", "", "01.12.2025", "a"),
        ("HV", "des25", "1", "0301", "NULL", "NULL", "2024-05-01", "b"),
        ("HV", "des25", "2", "0302", None, None, "x", "c"),
        ("HV", "des25", "NULL", "0301", "1", "2020", "01.12.2025", "d"),
        ("HV", "des25", "NPRId", "KommuneNr", "BydelNr", "År", "StartDato", "Ã"),
        ("HMN", "des25", "3", "", "7", "2025", "01.12.2025", "e"),
        ("HMN", "des25", "1", "0399", "", "", "01.11.2023", "f"),
        ("HMN", "des25", "", "1", "1", "1", "1", "g"),
        ("HMN", "jan26", "1", "0301", "", "2025", "01.12.2025", "h"),
        ("HMN", "jan26", None, "1", "1", "1", "1", "i"),
        ("HMN", "jan26", "5", "NULL", "", "2026", "05.01.2026", "j"),
    ]
    return table(spark, rows, REPORT)


@pytest.fixture
def id_map(spark):
    rows = [
        ("des25", "1", "101"), ("des25", "2", "102"), ("des25", "3", "NULL"), ("des25", "9", "109"),
        ("jan26", "1", "201"), ("jan26", "5", ""),
    ]
    return table(spark, rows, "suffix string, NPRId string, lopenr string")


@pytest.fixture
def history(spark):
    rows = [
        ("1", "0300", "4", 2020), ("1", "0301", "5", 2021), ("1", "0301", "6", 2021), ("1", "9999", "9", None),
        ("3", "0400", "1", 2008), ("7", "0500", "1", 2024),
    ]
    return table(spark, rows, "NPRId string, komnrhjem2 string, bydel2 string, aar int")


def test_request(report):
    assert as_set(request_ids(report), "suffix", "NPRId", "Dummy") == {
        ("des25", "1", ""), ("des25", "2", ""), ("des25", "3", ""), ("jan26", "1", ""), ("jan26", "5", ""),
    }


def test_unmapped(report, id_map):
    assert as_set(unmapped_ids(report, id_map), "suffix", "NPRId", "lopenr") == {
        ("des25", "3", "NULL"), ("jan26", "5", ""),
    }
    assert duplicate_keys(id_map).count() == 0


def test_padded_key_is_another_key(spark, id_map):
    padded = table(spark, [("HV", "des25", " 1")], "region string, suffix string, NPRId string")
    assert as_set(unmapped_ids(padded, id_map), "NPRId", "lopenr") == {(" 1", None)}


def test_duplicates_and_examples(spark):
    rows = [("des25", str(i), "1") for i in range(100, 120)] * 2 + [("des25", "", "1")] * 2 + [("jan26", "7", "1")] * 3
    dup = duplicate_keys(table(spark, rows, "suffix string, NPRId string, lopenr string"))
    assert dup.count() == 21
    examples = as_set(first_examples(dup), "suffix", "sample")
    assert examples == {("des25", ", ".join(str(i) for i in range(100, 110))), ("jan26", "7")}


def test_latest_location(history):
    assert as_set(latest_location(history), "NPRId", "komnrhjem2", "bydel2", "aar") == {
        ("1", "0301", "5", 2021), ("3", "0400", "1", 2008), ("7", "0500", "1", 2024),
    }


def test_override_only_for_latest_year(spark, history):
    overrides = override_table(spark, [("1", 2020, "1111"), ("3", 2008, "2222")])
    done = apply_overrides(latest_location(history), overrides)
    assert as_set(done, "NPRId", "komnrhjem2", "aar") == {("1", "0301", 2021), ("3", "2222", 2008), ("7", "0500", 2024)}


def test_fixes_only_for_needed_keys(report, history):
    needed = ids_missing_municipality(report)
    expected = {("des25", "1"), ("des25", "3"), ("jan26", "5")}
    assert as_set(needed, "suffix", "NPRId") == expected
    assert as_set(keys_missing_municipality(key_profile(report)), "suffix", "NPRId") == expected
    fixes = location_fixes(history, needed)
    assert as_set(fixes, "suffix", "NPRId", "komnrhjem2") == {("des25", "1", "0301"), ("des25", "3", "0400")}


def test_history_key_in_any_case_and_empty(spark):
    odd = table(spark, [(1, 301, 5, "2020")], "NPRid int, komnrhjem2 int, bydel2 int, aar string")
    assert as_history(odd).first() == ("1", "301", "5", 2020)
    assert empty_history(spark).columns == as_history(odd).columns


@pytest.mark.parametrize(
    "kommune, bydel, expected_kommune, original, filled",
    [
        (None, None, "0301", None, "5"),
        ("", "", "0301", "", ""),
        ("NULL", None, "0301", None, "5"),
        ("0301", None, "0301", "5", "5"),
        ("0301", "", "0301", "5", ""),
        ("0301", "NULL", "0301", "5", "NULL"),
        ("0301", "8", "0301", "8", "8"),
        ("0999", None, "0999", None, None),
    ],
)
def test_fill(spark, kommune, bydel, expected_kommune, original, filled):
    report = table(spark, [("des25", "1", kommune, bydel)], "suffix string, NPRId string, KommuneNr string, BydelNr string")
    fixes = table(spark, [("des25", "1", "0301", "5", 2021)], "suffix string, NPRId string, komnrhjem2 string, bydel2 string, aar int")
    assert fill_location(report, fixes, "original").select("KommuneNr", "BydelNr").first() == (expected_kommune, original)
    assert fill_location(report, fixes, "filled").select("KommuneNr", "BydelNr").first() == (expected_kommune, filled)


def test_delivery(report, id_map, history):
    fixes = location_fixes(history, ids_missing_municipality(report))
    done = deliver(report, id_map, fixes, OPTIONS)
    assert done.columns == ["region", "suffix", *DELIVERY_COLUMNS]
    assert as_set(done, "region", "suffix", "lopenr", "KommuneNr", "BydelNr", "År", "Pakkeforløp") == {
        # No delivered row of HV has a year, so it comes from the start date where that is a date.
        ("HV", "des25", "101", "0301", "NULL", "2025", "a"),
        ("HV", "des25", "101", "0301", "5", "2024", "b"),
        ("HV", "des25", "102", "0302", "NULL", "NULL", "c"),
        # The only year of HMN in December is on a row that is not delivered.
        ("HMN", "des25", "101", "0399", "NULL", "2023", "f"),
        # Nobody misses a municipality with that key in January, so the district stays empty.
        ("HMN", "jan26", "201", "0301", "NULL", "2025", "h"),
    }
    assert done.where("OF1 IS NULL OR OF1 = ''").count() == 0


def test_partly_missing_year_stays(spark, id_map):
    rows = [("HV", "des25", "1", "1", "1", "2019", "01.12.2025", ""), ("HV", "des25", "2", "1", "1", "", "01.12.2025", "")]
    done = deliver(table(spark, rows, REPORT), id_map, None, OPTIONS)
    assert as_set(done, "lopenr", "År") == {("101", "2019"), ("102", "NULL")}


def test_absent_year_and_start(spark, id_map):
    bare = table(spark, [("HV", "des25", "1", None, "2")], "region string, suffix string, NPRId string, KommuneNr string, BydelNr string")
    row = deliver(bare, id_map, None, OPTIONS).first()
    assert (row["År"], row["KommuneNr"], row["BydelNr"], row["lopenr"]) == ("NULL", "NULL", "2", "101")


def test_own_number_under_a_broken_name(spark, id_map):
    rows = [("HV", "des25", "1", "9"), ("HV", "des25", "3", "8"), ("HV", "des25", "4", "7"), ("HV", "des25", "6", "")]
    report = table(spark, rows, "region string, suffix string, NPRId string, enr string").selectExpr(
        "*", "'0301' AS KommuneNr", "'' AS BydelNr"
    )
    done = deliver(report, id_map, None, OPTIONS)
    assert as_set(done, "lopenr") == {("101",), ("8",), ("7",)}
    counts = delivery_counts(key_profile(report), id_map, None).first()
    assert counts["rows"] == 3


def test_typed_delivery(spark, id_map):
    report = table(
        spark, [("HV", "des25", "1", " 12 ", "a"), ("HV", "des25", "2", "x", "")],
        "region string, suffix string, NPRId string, institusjonId string, OF1 string",
    ).selectExpr("*", "'1' AS KommuneNr", "'2' AS BydelNr")
    typed = replace(OPTIONS, integer_columns=("institusjonId", "lopenr"), missing_token=None)
    done = deliver(report, id_map, None, typed)
    assert as_set(done, "lopenr", "institusjonId", "OF1") == {(101, 12, "a"), (102, None, None)}
    assert as_set(cast_loss(report, ["institusjonId"]), "region", "institusjonId_nonempty", "institusjonId_lost") == {
        ("HV", 2, 1)
    }
    odd = id_map.replace("102", "10x")
    keys = key_table(key_profile(report, typed.integer_columns), odd)
    assert as_set(gates_of(totals(keys, typed.integer_columns), keys), "gate", "region", "failures") == {
        ("cast_loss:institusjonId", "HV", 1), ("cast_loss:lopenr", "HV", 1),
    }


def test_summary_equals_counts_from_the_profile(report, id_map, history):
    fixes = location_fixes(history, ids_missing_municipality(report))
    done = deliver(report, id_map, fixes, OPTIONS)
    seen = as_set(qc_summary(done), "RHF", "suffix", "rows", "missing_kommune")
    told = delivery_counts(key_profile(report), id_map, fixes)
    assert seen == as_set(told, "region", "suffix", "rows", "missing_kommune")
    assert as_set(told, "mojibake") == {(0,)}


def test_month_control(report, id_map):
    done = deliver(report, id_map, None, OPTIONS)
    assert as_set(month_control(done, 2025), "region", "month", "n_rows") == {("HV", 12, 1), ("HMN", 12, 1)}


def test_id_profile(report):
    assert as_set(id_profile(key_profile(report)), "suffix", "n_rows", "n_distinct", "n_valid") == {
        ("des25", 8, 6, 3), ("jan26", 3, 3, 2),
    }


def test_gates(spark, report, id_map):
    profile = key_profile(report)

    def gates(answers):
        keys = key_table(profile, answers)
        return gates_of(totals(keys), keys)

    found = as_set(gates(id_map), "gate", "suffix", "failures", "sample")
    assert found == {("unmapped", "des25", 1, "3"), ("unmapped", "jan26", 1, "5")}
    only_december = id_map.where("suffix = 'des25'")
    bad = only_december.unionByName(only_december.where("NPRId = '9'"))
    failures = gates(bad).collect()
    assert {(r["gate"], r["suffix"]) for r in failures} == {
        ("map_empty", "jan26"), ("map_duplicates", "des25"), ("unmapped", "des25"), ("unmapped", "jan26"),
    }
    assert len(enforce(failures, [])) == 4
    with pytest.raises(GateFailed, match="map_duplicates des25: 1 .9."):
        enforce(failures, ["map_duplicates"])


def test_metrics(report, id_map, history):
    profile = key_profile(report)
    fixes = location_fixes(history, ids_missing_municipality(report))
    metrics = metrics_of(totals(key_table(profile, id_map, fixes)))
    found = {(r["suffix"], r["region"], r["metric"]): r["value"] for r in metrics.collect()}
    assert found["des25", "HV", "input_rows"] == 5
    assert found["des25", None, "total_rows"] == 8
    assert found["des25", None, "distinct_ids"] == 6
    assert found["des25", None, "request_rows"] == 3
    assert found["des25", None, "return_rows"] == 4
    assert found["des25", None, "missing_kommune_ids"] == 2
    assert found["des25", None, "geo_rows"] == 2
    assert found["des25", "HV", "delivery_rows"] == 3


def test_options():
    assert OPTIONS.suffixes == ("des25", "jan26")
    assert DeliveryOptions(months=("2025-12-01", "2025-12-01")).suffixes == ("des25",)
    for bad in ({"alias_policy": "x"}, {"district_fill": "x"}, {"max_rows_per_file": 0}, {"tie_delimiter": "|"}):
        with pytest.raises(ValueError):
            DeliveryOptions(**bad)
    with pytest.raises(ValueError):
        DeliveryOptions().suffixes
    with pytest.raises(ValueError):
        DeliveryOptions(months=("desember",)).suffixes
