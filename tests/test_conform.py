import pytest

from postbud.operators.conform import (
    MissingKeyColumn,
    conform,
    drop_column_at_if_empty,
    drop_empty_columns,
    empty_columns,
    missing_column_report,
    missing_columns,
    output_shape,
    plan_header,
    rescue_number,
    union_regions,
)
from postbud.layout import DELIVERY_COLUMNS
from postbud.operators.quality import empty_column_report, missing_by_group, mojibake_by_column
from postbud.options import DeliveryOptions

OPTIONS = DeliveryOptions()


def test_plan_header_renames_by_key():
    plan = plan_header([" NPR Id", "Kommune", "textbox74", "Startdato2", "Noe annet"])
    assert plan.names == ("NPRId", "KommuneNr", "reshIdFagEnhet", "År", "Noe annet")
    assert plan.collisions == ()


def test_plan_header_unique_and_first_policy():
    header = ["NPRId", "Kommune", "kommune "]
    assert plan_header(header).names == ("NPRId", "Kommune...2", "kommune...3")
    assert plan_header(header, policy="first").names == ("NPRId", "KommuneNr", "kommune...3")


def test_plan_header_reports_two_headers_for_one_column():
    plan = plan_header(["institusjonnavn", "institusjon", "NPRId"])
    assert plan.names == ("institusjonnavn", "institusjon", "NPRId")
    assert plan.collisions == (("institusjonnavn", "institusjon"),)


def test_plan_header_keeps_names_apart():
    plan = plan_header(["NPRId", "region", "", "a", "A"])
    assert plan.names == ("NPRId", "region...2", "...3", "a...4", "A...5")


def test_conform_adds_location_and_needs_key(spark):
    df = spark.createDataFrame([("1", "x")], ["nprid", "Enhet navn"])
    done = conform(df, OPTIONS)
    assert done.columns == ["NPRId", "Fagenhet", "KommuneNr", "BydelNr"]
    assert done.first() == ("1", "x", "NULL", "NULL")
    with pytest.raises(MissingKeyColumn):
        conform(spark.createDataFrame([("1",)], ["person"]), OPTIONS)


def test_empty_columns(spark):
    df = spark.createDataFrame([("1", "", None, " "), ("2", None, None, "")], "a string, b string, c string, d string")
    assert empty_columns(df) == ["b", "c"]
    assert drop_empty_columns(df).columns == ["a", "d"]
    assert empty_columns(df.limit(0)) == []
    flags = {r["column_name"]: r["is_empty"] for r in empty_column_report(df).collect()}
    assert flags == {"a": False, "b": True, "c": True, "d": False}


def test_drop_column_by_position(spark):
    df = spark.createDataFrame([("1", "", "x")], ["a", "b", "c"])
    assert drop_column_at_if_empty(df, 2)[0].columns == ["a", "c"]
    kept, dropped = drop_column_at_if_empty(df, 3)
    assert kept.columns == ["a", "b", "c"] and not dropped
    assert drop_column_at_if_empty(df, 13) == (df, False)


def test_union_and_missing_columns(spark):
    a = spark.createDataFrame([("1", "2")], ["NPRId", "OF1"])
    b = spark.createDataFrame([("3", "4")], ["OF2", "NPRId"])
    assert sorted(union_regions([a, b]).select("NPRId", "OF1", "OF2").collect(), key=str) == [
        ("1", "2", None), ("4", None, "3"),
    ]
    assert missing_columns(a.columns, ["OF1", "OF2"]) == ["OF2"]
    report = missing_column_report(spark, {("HV", "des25"): a.columns}, ["OF1", "OF2"])
    assert report.collect() == [("HV", "des25", "OF2")]


def test_missing_by_group(spark):
    df = spark.createDataFrame(
        [("HV", "des25", "x", ""), ("HMN", "des25", "", "y")], ["region", "suffix", "OF1", "OF2"]
    )
    found = missing_by_group(df, ["OF1", "OF2", "OF3"])
    rows = sorted(found.select("region", "suffix", "missing_column").collect())
    assert rows == [
        ("HMN", "des25", "OF1"), ("HMN", "des25", "OF3"), ("HV", "des25", "OF2"), ("HV", "des25", "OF3"),
    ]


def test_rescue_number(spark):
    only = spark.createDataFrame([("9",)], ["enr"])
    assert rescue_number(only).columns == ["lopenr"]
    both = spark.createDataFrame([("1", "9"), ("", "8"), (None, "7"), ("NULL", "6")], ["lopenr", "enr"])
    assert [r[0] for r in rescue_number(both).collect()] == ["1", "8", "7", "6"]
    assert rescue_number(both).columns == ["lopenr"]


def test_output_shape(spark):
    df = spark.createDataFrame([(7, "", None, "NULL")], "`År` int, OF1 string, OF2 string, OF3 string")
    shaped = output_shape(df, OPTIONS)
    assert shaped.columns == list(DELIVERY_COLUMNS)
    row = shaped.first()
    assert (row["År"], row["OF1"], row["OF2"], row["OF3"], row["Xinst"]) == ("7", "NULL", "NULL", "NULL", "NULL")
    assert output_shape(shaped, OPTIONS).first() == row
    typed = DeliveryOptions(integer_columns=("lopenr",), missing_token=None)
    assert output_shape(df, typed).schema["lopenr"].dataType.typeName() == "integer"


def test_mojibake_by_column(spark):
    df = spark.createDataFrame([("Ã", "a"), ("x", "Â"), (None, "Ã")], ["p", "q"])
    assert sorted(mojibake_by_column(df).collect()) == [("p", 1), ("q", 2)]
