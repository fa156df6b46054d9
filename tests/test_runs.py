"""Both runs over files, from exports to deliveries."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from postbud.layout import DELIVERY_COLUMNS
from postbud.operators.quality import GateFailed
from postbud.options import DeliveryOptions
from postbud.plans import runs
from postbud.plans.runs import run
from postbud.session import shared_folder
from postbud.sinks.files import RowsLost, read_table
from postbud.sources.tables import MissingReturnFile

HEAD = "﻿" + ";".join(DELIVERY_COLUMNS)


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content.encode())


@pytest.fixture
def options(tmp_path):
    home = tmp_path / "in"
    put(home / "HSØ/Uttrekk RHF_HSØ_des25.csv", (
        "NPRId;Kommune;BydelNr;Pakkeforløp;StartDato\r\n"
        "1;;;BrystkrÃ¦ft;01.12.2025\r\n2;0301;;Lunge;2025-11-30\r\n2;NULL;3;Lunge;\r\nNULL;1;1;1;1\r\n"
    ))
    put(home / "HV/Uttrekk RHF_HV_des25.csv", "NPRId,KommuneNr,Pakkeforløp,År\n1,1201,Prostata,2024\n3,,Prostata,\n")
    put(home / "HMN/Uttrekk RHF_HMN_des25.csv", "NPRId;KommuneNr\n")
    put(home / "HV/Uttrekk RHF_HV_jan26.csv", "NPRId;År\n4;2026\n")
    return DeliveryOptions(
        months=("2025-12-01",), base_dir=str(home), app_dir=str(tmp_path / "app"), out_dir=str(tmp_path / "out")
    )


@pytest.fixture
def history(spark):
    rows = [("1", "0301", "5", 2020), ("2", "0301", "9", 2021), ("3", "0400", "1", 2021)]
    return spark.createDataFrame(rows, "NPRId string, komnrhjem2 string, bydel2 string, aar int")


def answer(tmp_path, text, suffix="des25"):
    put(tmp_path / f"app/NPRId_RHF_Pakkeforløp_{suffix}_lnr.csv", text)


def lines(path):
    """Lines of a file, or of the one part that a small folder holds."""
    if path.is_dir():
        (path,) = path.glob("part-*.csv")
    return path.read_text(encoding="utf-8").splitlines()


def test_request_run(spark, options, tmp_path):
    result = run(spark, "step1", options)
    assert result.status == "step1_done"
    path = result.files["request"]["des25",]
    assert path == str(tmp_path / "app/NPRId_RHF_Pakkeforløp_des25.csv")
    assert lines(tmp_path / "app/NPRId_RHF_Pakkeforløp_des25.csv") == ["NPRId;Dummy", "1;", "2;", "3;"]


def test_delivery_run(spark, options, history, tmp_path):
    answer(tmp_path, "1;100\r\n2; 200 \r\n3;NULL\r\n9;900\r\n")
    result = run(spark, "STEP2", options, history)
    assert result.status == "delivered"
    out = tmp_path / "out"

    south = lines(out / "Utlevering_HSØ_des25.csv")
    assert south[0] == HEAD
    cells = sorted([dict(zip(DELIVERY_COLUMNS, row.split(";"))) for row in south[1:]], key=lambda r: r["StartDato"])
    found = [(r["lopenr"], r["KommuneNr"], r["BydelNr"], r["Pakkeforløp"], r["År"]) for r in cells]
    assert found == [
        ("100", "0301", "NULL", "Brystkræft", "2025"),
        ("200", "0301", "9", "Lunge", "2025"),
        ("200", "0301", "3", "Lunge", "NULL"),
    ]
    (west,) = lines(out / "Utlevering_HV_des25.csv")[1:]
    assert west.startswith("100;") and ";1201;" in west and ";2024;" in west
    assert lines(out / "Utlevering_HMN_des25.csv") == [HEAD]

    assert lines(out / "QC_missing_lopenr_NPRId_des25.csv") == ["NPRId,lopenr", "3,NULL"]
    assert lines(out / "QC_summary_des25.csv") == ["RHF,suffix,rows,missing_kommune", "HMN,des25,0,0", "HSØ,des25,3,0", "HV,des25,1,0"]
    missing = lines(out / "QC_missing_columns_HSØ_des25.csv")
    assert missing[0] == "region,suffix,missing_column" and "HSØ,des25,institusjon" in missing
    assert not any(c in line for line in missing for c in ("År", "KommuneNr", "lopenr"))
    metrics = {(r["region"], r["metric"]): r["value"] for r in result.metrics.collect()}
    assert metrics["HSØ", "input_rows"] == 4 and metrics[None, "return_rows"] == 4
    assert metrics["HMN", "delivery_rows"] == 0
    assert [(w["gate"], w["failures"]) for w in result.warnings] == [("unmapped", 1)]


def test_months_in_one_run(spark, options, history, tmp_path):
    two = replace(options, months=("2025-12-01", "2026-01-01"), strict_input=False, cache_dir=str(tmp_path / "cache"))
    answer(tmp_path, "1;100\n2;200\n3;300\n")
    answer(tmp_path, "4;400\n", "jan26")
    result = run(spark, "STEP2", two, history)
    assert sorted(result.files["delivery"]) == [
        ("HMN", "des25"), ("HSØ", "des25"), ("HV", "des25"), ("HV", "jan26"),
    ]
    assert lines(tmp_path / "out/Utlevering_HV_jan26.csv")[1].startswith("400;")
    assert lines(tmp_path / "app/NPRId_RHF_Pakkeforløp_jan26.csv") == ["NPRId;Dummy", "4;"]


def test_stops(spark, options, history, tmp_path):
    with pytest.raises(MissingReturnFile):
        run(spark, "STEP2", options, history)
    answer(tmp_path, "1;100\n1;101\n2;200\n3;300\n")
    with pytest.raises(GateFailed, match="map_duplicates"):
        run(spark, "STEP2", options, history)
    answer(tmp_path, "1;100\n2;200\n")
    with pytest.raises(GateFailed, match="unmapped des25: 1 .3."):
        run(spark, "STEP2", replace(options, strict_lopenr=True), history)
    assert lines(tmp_path / "out/QC_missing_lopenr_NPRId_des25.csv")[1:] == ["3,"]
    answer(tmp_path, "")
    with pytest.raises(GateFailed, match="map_empty"):
        run(spark, "STEP2", options, history)
    answer(tmp_path, "1;100\n2;200\n3;300\n")
    with pytest.raises(GateFailed, match="mojibake_out des25 HSØ: 1"):
        run(spark, "STEP2", replace(options, repair_mojibake=False), history)
    assert not list((tmp_path / "out").glob("Utlevering*"))
    with pytest.raises(ValueError):
        run(spark, "STEP3", options)


def test_one_file_a_name(spark, options, history, tmp_path):
    answer(tmp_path, "1;100\n2;200\n3;300\n")
    run(spark, "STEP2", replace(options, one_file=True), history)
    names = ["app/NPRId_RHF_Pakkeforløp_des25.csv", *(f"out/Utlevering_{r}_des25.csv" for r in ("HSØ", "HV", "HMN"))]
    assert all((tmp_path / name).is_file() for name in names)
    run(spark, "STEP2", options, history)
    assert all((tmp_path / name).is_dir() for name in names)
    assert len(lines(tmp_path / names[1])) == 4


DELIVERY = StructType([StructField(c, StringType()) for c in ("region", "suffix", *DELIVERY_COLUMNS)])


def test_table_follows_the_files(spark, options, history, tmp_path):
    answer(tmp_path, "1;100\n2;200\n3;300\n")
    run(spark, "STEP2", options, history)
    table = read_table(spark, str(tmp_path / "out/deliveries"), DELIVERY)
    assert {(r["region"], r["count"]) for r in table.groupBy("region").count().collect()} == {("HSØ", 3), ("HV", 2)}
    put(tmp_path / "in/HV/Uttrekk RHF_HV_des25.csv", "NPRId,KommuneNr\n")
    run(spark, "STEP2", options, history)
    table = read_table(spark, str(tmp_path / "out/deliveries"), DELIVERY)
    assert {r["region"] for r in table.select("region").collect()} == {"HSØ"}
    assert lines(tmp_path / "out/Utlevering_HV_des25.csv") == [HEAD]


def test_a_delivery_of_the_wrong_size_changes_nothing(spark, options, history, tmp_path, monkeypatch):
    answer(tmp_path, "1;100\n2;200\n3;300\n")
    run(spark, "STEP2", options, history)
    files = {p: p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file() and not p.name.startswith("QC")}
    right = runs.deliver
    monkeypatch.setattr(runs, "deliver", lambda *a, **k: right(*a, **k).where("lopenr <> '100'"))
    with pytest.raises(RowsLost):
        run(spark, "STEP2", options, history)
    assert {p: p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file() and not p.name.startswith("QC")} == files


def test_overrides_and_checks_that_only_warn(spark, options, history, tmp_path):
    two = replace(
        options, months=("2025-12-01", "2026-01-01"), strict_input=False, warn_only=("missing_returns", "map_empty"),
        overrides=(("1", 2020, "0999"),),
    )
    answer(tmp_path, "1;100\n2;200\n3;300\n")
    result = run(spark, "STEP2", two, history)
    assert {(w["gate"], w["suffix"]) for w in result.warnings} >= {("missing_returns", "jan26"), ("map_empty", "jan26"), ("unmapped", "jan26")}
    assert any(";0999;" in line for line in lines(tmp_path / "out/Utlevering_HSØ_des25.csv"))
    table = spark.createDataFrame([("1", 2020, "0888")], "NPRId string, aar int, komnrhjem2 string")
    run(spark, "STEP2", two, history, table)
    assert any(";0888;" in line for line in lines(tmp_path / "out/Utlevering_HSØ_des25.csv"))


def test_nothing_is_left_in_the_shared_folder(spark, options, history, tmp_path):
    root = Path(shared_folder(spark).removeprefix("file:")) / "postbud"
    before = set(root.rglob("*")) if root.exists() else set()
    run(spark, "STEP1", options)
    answer(tmp_path, "1;100\n2;200\n3;300\n")
    result = run(spark, "STEP2", options, history)
    answer(tmp_path, "1;100\n1;101\n2;200\n3;300\n")
    with pytest.raises(GateFailed):
        run(spark, "STEP2", options, history)
    assert {p for p in set(root.rglob("*")) - before if p != root and not p.name.startswith("session-")} == set()
    assert result.metrics.count() > 0


def test_nothing_to_do(spark, options, tmp_path):
    empty = replace(options, base_dir=str(tmp_path / "empty"))
    assert run(spark, "STEP1", empty).status == "no_inputs"
    assert run(spark, "STEP2", empty).status == "no_inputs"


def test_without_filling(spark, options, tmp_path):
    answer(tmp_path, "1;100\n2;200\n3;300\n")
    result = run(spark, "STEP2", replace(options, fill_missing_kommune=False))
    summary = lines(tmp_path / "out/QC_summary_des25.csv")
    assert result.status == "delivered" and "HSØ,des25,3,2" in summary
