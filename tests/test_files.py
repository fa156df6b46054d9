"""Reading and writing files: odd exports, returned numbers, deliveries byte by byte."""

import os
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from postbud.operators.conform import MissingKeyColumn
from postbud.options import DeliveryOptions
from postbud.sinks.files import RowsLost, _publish, read_table, write_files, write_table
from postbud.sources.exports import MissingInput, MojibakeFound, find_exports, load_reports
from postbud.sources.files import detect_delimiter, profile
from postbud.sources.tables import MissingReturnFile, missing_returns, read_returns

HSO = "HSØ"


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return path


@pytest.fixture
def options(tmp_path):
    return DeliveryOptions(
        months=("2025-12-01",), base_dir=str(tmp_path / "in"), app_dir=str(tmp_path / "app"),
        out_dir=str(tmp_path / "out"),
    )


def rows(reports, *columns):
    return sorted(
        [tuple(r) for r in reports.rows.select(*columns).collect()], key=lambda r: tuple(str(v) for v in r)
    )


def test_detect_delimiter(apply):
    heads = ["a;b,c;d", "a,b;c,d", "a;b,c", "a,b;;", ""]
    assert apply(detect_delimiter, heads) == [";", ",", ";", ";", ";"]
    assert apply(lambda c: detect_delimiter(c, ","), heads) == [";", ",", ",", ",", ","]


def test_export_with_bom_crlf_quotes_and_ragged_rows(spark, options, tmp_path):
    put(
        tmp_path / "in" / HSO / f"Uttrekk RHF_{HSO}_des25.csv",
        '﻿NPRId ;Kommune;OF1\r\n1; 0301 ;"a ""b"";c"\r\n\r\n2\r\n3;;x\ry;overflødig\r\n',
    )
    reports = load_reports(spark, options)
    assert rows(reports, "region", "suffix", "NPRId", "KommuneNr", "OF1", "BydelNr") == [
        (HSO, "des25", "1", " 0301 ", 'a "b";c', "NULL"),
        (HSO, "des25", "2", "", "", "NULL"),
        (HSO, "des25", "3", "", "xy", "NULL"),
    ]
    assert reports.absent == (("HV", "des25"), ("HMN", "des25"))


def test_encodings(spark, options, tmp_path):
    header = "NPRId,Pakkeforløp\n"
    put(tmp_path / "in/HV/RHF_HV_des25.csv", (header + "1,Bryst – 5 € ø\n").encode("cp1252"))
    put(tmp_path / "in/HMN/RHF_HMN_des25.csv", header + "2,PakkeforlÃ¸p\n3,日本\n")
    files, _ = find_exports(spark, options)
    assert {f.targets[0][0]: f.encoding for f in files} == {"HV": "Windows-1252", "HMN": "UTF-8"}
    reports = load_reports(spark, options)
    assert rows(reports, "NPRId", "Pakkeforløp") == [("1", "Bryst – 5 € ø"), ("2", "Pakkeforløp"), ("3", "日本")]
    raw = load_reports(spark, replace(options, repair_mojibake=False))
    assert ("2", "PakkeforlÃ¸p") in rows(raw, "NPRId", "Pakkeforløp")
    with pytest.raises(MojibakeFound):
        load_reports(spark, replace(options, repair_mojibake=False, fail_on_mojibake=True))
    forced = load_reports(spark, replace(options, encoding_override="utf-8", repair_mojibake=False))
    assert forced.rows.count() == 3


def test_repeated_header_row(spark, options, tmp_path):
    body = "NPRId;OF1\nNPRId;OF1\n1;a\nNPRId;OF1x\n"
    put(tmp_path / "in/HV/RHF_HV_des25.csv", body)
    assert rows(load_reports(spark, options), "NPRId", "OF1") == [("1", "a"), ("NPRId", "OF1x")]


def test_only_the_first_row_of_the_first_part_can_repeat_the_header(spark, options, tmp_path):
    folder = tmp_path / "in/HV/RHF_HV_des25.csv"
    put(folder / "part-0.csv", "NPRId;OF1\n")
    put(folder / "part-1.csv", "NPRId;OF1\nNULL;x\nNULL;x\n1;a\n")
    put(folder / "part-2.csv", "NPRId;OF1\nNPRId;OF1\n2;b\n")
    put(tmp_path / "in/HMN/RHF_HMN_des25.csv", "npr id;OF1\nNPRId;OF1\n3;c\n")
    expected = [("1", "a"), ("2", "b"), ("3", "c"), ("NPRId", "OF1"), ("NPRId", "OF1"), ("NULL", "x")]
    assert rows(load_reports(spark, options), "NPRId", "OF1") == expected


def test_an_export_is_parsed_once_and_profiled_by_one_job(spark, options, tmp_path):
    for part in range(30):
        put(tmp_path / f"in/HV/RHF_HV_des25.csv/part-{part:02d}.csv", f"NPRId;OF1\n{part};a\n")
    group = "profile-job"
    spark.sparkContext.setJobGroup(group, group)
    files, _ = find_exports(spark, options)
    (facts,) = files
    assert len(facts.parts) == 30 and facts.header == ("NPRId", "OF1")
    profiled = profile(spark, [f"{options.base_dir}/HV"], options)
    plan = profiled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "SortAggregate" not in plan
    reports = load_reports(spark, options)
    for df in (reports.rows, reports.rows.select("NPRId").distinct()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "FileScan csv" not in plan and "FileScan text" not in plan
    assert "c0#" in plan and "c1#" not in plan


def test_a_part_that_cannot_be_read_raises(spark, options, tmp_path, monkeypatch):
    bad = put(tmp_path / "in/HV/RHF_HV_des25.csv/part-0.csv.gz", b"this is no archive")
    put(bad.parent / "part-1.csv", "NPRId\n1\n")
    with pytest.raises(Exception, match="gzip"):
        load_reports(spark, options)


def test_which_file(spark, options, tmp_path):
    folder = tmp_path / "in/HV"
    old = put(folder / "a RHF_HV_des25.csv", "NPRId\n1\n")
    new = put(folder / "b rhf_hv_DES25.CSV", "NPRId\n2\n")
    put(folder / "c RHF_HV_jan26.csv", "NPRId\n3\n")
    put(folder / "d RHF_HV_des25.csv.bak", "NPRId\n4\n")
    os.utime(old, (1_000_000, 1_000_000))
    os.utime(new, (2_000_000, 2_000_000))
    assert rows(load_reports(spark, options), "NPRId") == [("2",)]
    os.utime(old, (3_000_000, 3_000_000))
    assert rows(load_reports(spark, options), "NPRId") == [("1",)]


def test_strict_and_lenient_input(spark, options, tmp_path):
    put(tmp_path / "in/HV/RHF_HV.csv", "NPRId\n1\n")
    with pytest.raises(MissingInput):
        load_reports(spark, options)
    two = replace(options, strict_input=False, months=("2025-12-01", "2026-01-01"))
    put(tmp_path / "in/HV/RHF_HV_jan26.csv", "NPRId\n2\n")
    assert rows(load_reports(spark, two), "suffix", "NPRId") == [("des25", "1"), ("jan26", "2")]
    assert load_reports(spark, replace(options, base_dir=str(tmp_path / "nowhere"))) is None


def test_one_file_for_two_months(spark, options, tmp_path):
    put(tmp_path / "in/HV/RHF_HV.csv", "NPRId\n1\n")
    two = replace(options, strict_input=False, months=("2025-12-01", "2026-01-01"))
    assert rows(load_reports(spark, two), "suffix", "NPRId") == [("des25", "1"), ("jan26", "1")]


def test_export_in_parts(spark, options, tmp_path):
    folder = tmp_path / "in/HV/RHF_HV_des25.csv"
    put(folder / "part-0.csv", "NPRId;Pakkeforløp\n1;Ã¸\n")
    put(folder / "part-1.csv", "NPRId;Pakkeforløp\n2;b\n3;c\n")
    put(folder / "_SUCCESS", "")
    put(tmp_path / "in/HV/arkiv/RHF_HV_des25.csv", "NPRId;Pakkeforløp\n9;z\n")
    expected = [("des25", "1", "ø"), ("des25", "2", "b"), ("des25", "3", "c")]
    assert rows(load_reports(spark, options), "suffix", "NPRId", "Pakkeforløp") == expected
    cached = load_reports(spark, replace(options, cache_dir=str(tmp_path / "cache")))
    assert rows(cached, "suffix", "NPRId", "Pakkeforløp") == expected


def test_returns_in_parts(spark, tmp_path):
    folder = tmp_path / "NPRId_RHF_Pakkeforløp_des25_lnr.csv"
    put(folder / "part-0.csv", "1;10\n")
    put(folder / "part-1.csv", "2;20\n")
    found = read_returns(spark, str(tmp_path), ["des25"])
    assert sorted(tuple(r) for r in found.collect()) == [("des25", "1", "10"), ("des25", "2", "20")]


def test_key_column_is_required(spark, options, tmp_path):
    put(tmp_path / "in/HV/RHF_HV_des25.csv", "person\n1\n")
    with pytest.raises(MissingKeyColumn):
        load_reports(spark, options)


def test_empty_column_rules_are_per_file(spark, options, tmp_path):
    put(tmp_path / "in/HV/RHF_HV_des25.csv", "institusjon;NPRId;institusjonnavn\n;1;A\n;2;\n")
    put(tmp_path / "in/HMN/RHF_HMN_des25.csv", "institusjon;NPRId;institusjonnavn\nB;3;\n")
    dropped = load_reports(spark, replace(options, drop_empty_columns=True))
    assert rows(dropped, "NPRId", "institusjon") == [("1", "A"), ("2", ""), ("3", "B")]
    assert dropped.present == {
        ("HV", "des25"): ("NPRId", "institusjon"), ("HMN", "des25"): ("institusjon", "NPRId"),
    }
    first = load_reports(spark, replace(options, drop_position=1))
    assert first.present[("HV", "des25")] == ("NPRId", "institusjon")
    assert first.present[("HMN", "des25")][:2] == ("institusjon", "NPRId")


def test_trim_ids(spark, options, tmp_path):
    put(tmp_path / "in/HV/RHF_HV_des25.csv", "NPRId\n 1 \n")
    assert rows(load_reports(spark, options), "NPRId") == [(" 1 ",)]
    assert rows(load_reports(spark, replace(options, trim_ids=True)), "NPRId") == [("1",)]


def test_line_feeds_in_quoted_cells(spark, options, tmp_path):
    put(tmp_path / "in/HV/RHF_HV_des25.csv", 'NPRId;OF1\r\n1;"a\n""b"\r\n2;c\r\n')
    put(tmp_path / "in/HMN/RHF_HMN_des25.csv", 'NPRId;OF1\n3;5" d\n4;"e;f"\n')
    expected = [("1", 'a\n"b'), ("2", "c"), ("3", '5" d'), ("4", "e;f")]
    files, _ = find_exports(spark, options)
    assert [f.broken_lines for f in files] == [True, True]
    assert rows(load_reports(spark, options), "NPRId", "OF1") == expected
    forced = replace(options, encoding_override="utf-8")
    assert rows(load_reports(spark, forced), "NPRId", "OF1") == expected


def python_records(text, delimiter=";"):
    """Cells of every record, character by character."""
    out, row, cell, state = [], [], "", "start"
    for c in text:
        if state == "inside":
            if c == '"':
                state = "maybe"
            else:
                cell += c
            continue
        if state == "maybe":
            if c == '"':
                cell, state = cell + '"', "inside"
                continue
            if c not in (delimiter, "\n"):  # the quote was no end, and the cell goes on without quotes
                cell, state = '"' + cell + '"', "plain"
        if c == delimiter:
            row, cell, state = [*row, cell], "", "start"
        elif c == "\n":
            out.append([*row, cell])
            row, cell, state = [], "", "start"
        elif c == '"' and state == "start":
            state = "inside"
        else:
            cell, state = cell + c, "plain" if state == "start" else state
    return [r for r in out if r != [""]]


@pytest.mark.parametrize("block", ["900", "100000"])
def test_quoted_line_feeds_in_many_blocks(spark, options, tmp_path, block):
    rng = random.Random(3)
    cells = ["a", "", '"b"', '"c\nd"', '"e""f"', '"g;h"', '"\n\n"', '5" i', '"j""\n""k"', '" ;\n"', "l m"]
    text = "NPRId;OF1;OF2\n" + "".join(f"{i};{rng.choice(cells)};{rng.choice(cells)}\n" for i in range(400))
    put(tmp_path / "in/HV/RHF_HV_des25.csv", text)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, block if k.endswith("PartitionBytes") else "0")
        reports = load_reports(spark, options)
        scanned = spark.read.text(str(tmp_path / "in/HV/RHF_HV_des25.csv")).rdd.getNumPartitions()
        assert scanned > 1 or block == "100000"
        found = rows(reports, "NPRId", "OF1", "OF2")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == sorted([tuple(r) for r in python_records(text)[1:]], key=lambda r: tuple(str(v) for v in r))


def test_a_quote_that_is_never_closed_raises(spark, options, tmp_path, monkeypatch):
    monkeypatch.setattr("postbud.sources.quoted.MAX_RECORD_LINES", 50)
    put(tmp_path / "in/HV/RHF_HV_des25.csv", 'NPRId;OF1\n1;"a\n' + "2;b\n" * 100)
    with pytest.raises(ValueError, match="never closed|goes on"):
        load_reports(spark, options)


def test_blank_lines_at_the_top(spark, options, tmp_path):
    put(tmp_path / "in/HV/RHF_HV_des25.csv", "\n\r\n\n \n\n\nNPRId;OF1\n\n1;a\n")
    assert rows(load_reports(spark, options), "NPRId", "OF1") == [("1", "a")]


def test_parts_with_headers_of_their_own(spark, options, tmp_path):
    folder = tmp_path / "in/HV/RHF_HV_des25.csv"
    put(folder / "part-0.csv", "NPRId;institusjon;KommuneNr\n1;A;0301\n")
    put(folder / "part-1.csv", "KommuneNr,NPRId,OF1\nKommuneNr,NPRId,OF1\n0302,2,x\n")
    put(folder / "part-2.csv", "")
    # Only the first row of the whole export can be a repeated header.
    expected = [("1", "A", "0301", None), ("2", None, "0302", "x"), ("NPRId", None, "KommuneNr", "OF1")]
    for how in (options, replace(options, cache_dir=str(tmp_path / "cache"))):
        reports = load_reports(spark, how)
        assert rows(reports, "NPRId", "institusjon", "KommuneNr", "OF1") == expected
        assert reports.present == {("HV", "des25"): ("NPRId", "institusjon", "KommuneNr", "OF1")}


def test_empty_export(spark, options, tmp_path):
    put(tmp_path / "in/HV/RHF_HV_des25.csv", "")
    with pytest.raises(MissingInput):
        load_reports(spark, options)


def test_multi_line_cells(spark, options, tmp_path):
    put(tmp_path / "in/HV/RHF_HV_des25.csv", 'NPRId;OF1\n1;"a\nb"\n2;c\n')
    whole = load_reports(spark, replace(options, multi_line=True))
    assert rows(whole, "NPRId", "OF1") == [("1", "a\nb"), ("2", "c")]


def test_cache(spark, options, tmp_path):
    cached = replace(options, cache_dir=str(tmp_path / "cache"))
    source = put(tmp_path / "in" / HSO / f"RHF_{HSO}_des25.csv", "NPRId;Enhet navn\n1;a\n")
    put(tmp_path / "in/HV/RHF_HV_des25.csv", "NPRId\n2\n")
    put(tmp_path / "in/HMN/RHF_HMN_des25.csv", "NPRId\n")
    expected = [(HSO, "1", "a"), ("HV", "2", None)]
    first = load_reports(spark, cached)
    assert rows(first, "region", "NPRId", "Fagenhet") == expected
    again = load_reports(spark, cached)
    assert rows(again, "region", "NPRId", "Fagenhet") == expected
    assert first.present == again.present
    assert "Scan csv" not in again.rows._jdf.queryExecution().toString()
    # Another state of the source, or another way of reading, is another entry.
    put(source, "NPRId;Enhet navn\n1;b\n9;c\n")
    assert rows(load_reports(spark, cached), "NPRId", "Fagenhet") == [("1", "b"), ("2", None), ("9", "c")]


def test_half_written_cache_entry_is_replaced(spark, options, tmp_path):
    cached = replace(options, cache_dir=str(tmp_path / "cache"))
    put(tmp_path / "in/HV/RHF_HV_des25.csv", "NPRId\n1\n")
    load_reports(spark, cached)
    (marker,) = (tmp_path / "cache").rglob("_COLUMNS")
    marker.unlink()
    assert rows(load_reports(spark, cached), "NPRId") == [("1",)]


def test_returns(spark, tmp_path):
    put(tmp_path / "NPRId_RHF_Pakkeforløp_des25_lnr.csv", b" 1 ;55\r\n2;\r\n;7\n3;NULL;x;y\n4;\" 8; \"\n")
    put(tmp_path / "NPRId_RHF_Pakkeforløp_jan26_lnr.csv", b"1;9\n")
    found = read_returns(spark, str(tmp_path), ["des25", "jan26"])
    assert sorted([tuple(r) for r in found.collect()], key=str) == [
        ("des25", "1", "55"), ("des25", "2", None), ("des25", "3", "NULL"), ("des25", "4", "8"),
        ("des25", None, "7"), ("jan26", "1", "9"),
    ]
    with pytest.raises(MissingReturnFile):
        read_returns(spark, str(tmp_path), ["feb26"])


def test_written_bytes(spark, tmp_path):
    df = spark.createDataFrame(
        [("HV", "1", "a;b", ""), ("HV", "2", ' "q" ', None)], "region string, lopenr string, OF1 string, OF2 string"
    )
    sizes = {("HV",): 2, ("HMN",): 0}
    for one_file in (True, False):
        out = write_files(
            df, ["region"], "U_{region}.csv", str(tmp_path), sizes=sizes, bom=True, sort_by=["lopenr"], one_file=one_file
        )
        assert out.rows == 2
        west, middle = tmp_path / "U_HV.csv", tmp_path / "U_HMN.csv"
        if not one_file:
            (west,), (middle,) = west.glob("part-*.csv"), middle.glob("part-*.csv")
        head = b"\xef\xbb\xbflopenr;OF1;OF2\n"
        assert west.read_bytes() == head + b'1;"a;b";\n2;" ""q"" ";\n'
        assert middle.read_bytes() == head
        assert not list(tmp_path.glob("_writing*"))


def test_groups_of_every_size_become_folders(spark, tmp_path):
    copies = spark.range(0, 1000, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'HV' WHEN id = 1 THEN 'HSØ' ELSE 'HMN' END AS region", "'same' AS a", "'row' AS b"
    )
    out = write_files(copies, ["region"], "{region}.csv", str(tmp_path), max_rows=400)
    assert out.rows == 1000
    for region, n, files in (("HV", 334, 1), ("HMN", 665, 2), ("HSØ", 1, 1)):
        sizes = [len(p.read_text().splitlines()) - 1 for p in (tmp_path / f"{region}.csv").glob("part-*.csv")]
        assert sum(sizes) == n and max(sizes) <= 400 and len(sizes) == files


def test_rewriting_replaces(spark, tmp_path):
    for n, one_file in ((5, True), (7, False), (2, True), (0, False)):
        df = spark.range(n).selectExpr("'HV' AS region", "CAST(id AS STRING) AS a")
        out = write_files(df, ["region"], "{region}.csv", str(tmp_path), sizes={("HV",): n}, one_file=one_file)
        read = spark.read.option("header", True).csv(out.paths[("HV",)])
        assert read.count() == n
    assert not list(tmp_path.glob("_writing*"))


def test_old_files_come_back_if_one_cannot_be_moved(spark, tmp_path):
    df = spark.createDataFrame([("HV", "1"), ("HMN", "2")], "region string, a string")
    write_files(df, ["region"], "{region}/x.csv", str(tmp_path), one_file=True)
    before = {p: p.read_bytes() for p in tmp_path.rglob("x.csv")}
    new = df.selectExpr("CASE region WHEN 'HV' THEN 'HV' ELSE 'HV/x.csv' END AS region", "'9' AS a")
    sizes = {("HV",): 1, ("HV/x.csv",): 1}
    with pytest.raises(Exception):
        write_files(new, ["region"], "{region}/x.csv", str(tmp_path), sizes=sizes, one_file=True)
    assert {p: p.read_bytes() for p in before} == before


def table_rows(spark, path, schema):
    return Counter(r["region"] for r in read_table(spark, path, schema).collect())


def test_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'HSØ' ELSE 'HV' END AS region", "'des25' AS suffix", "CAST(id AS STRING) AS lopenr"
    )
    assert table_rows(spark, path, df.schema) == {}
    write_table(df, path)
    assert table_rows(spark, path, df.schema) == {"HSØ": 34, "HV": 66}
    only = read_table(spark, path, df.schema, groups=[("des25", "HV"), ("des25", "HMN")])
    assert only.count() == 66 and sorted(map(tuple, only.collect()))[0] == ("HV", "des25", "1")
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "region=HS" not in plan
    write_table(df.where("region = 'HV'").limit(5), path)
    assert table_rows(spark, path, df.schema) == {"HSØ": 34, "HV": 5}
    write_table(df.limit(0), path, emptied=[("des25", "HSØ")])
    assert table_rows(spark, path, df.schema) == {"HV": 5}


def test_a_wrong_count_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(9).selectExpr("'HV' AS region", "'des25' AS suffix", "CAST(id AS STRING) AS lopenr")
    write_table(df, path, sizes={("des25", "HV"): 9, ("des25", "HMN"): 0})
    before = {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    moved = df.selectExpr("CASE WHEN lopenr = '0' THEN 'HMN' ELSE 'HV' END AS region", "suffix", "lopenr")
    for rows, told in ((df, 10), (df.limit(8), 9), (moved, 9)):
        with pytest.raises(RowsLost):
            write_table(rows, path, sizes={("des25", "HV"): told, ("des25", "HMN"): 0})
    broken = df.withColumn("lopenr", F.raise_error(F.lit("lost on the way")).cast("string"))
    with pytest.raises(Exception, match="lost on the way"):
        write_table(broken, path)
    assert {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()} == before
    assert table_rows(spark, path, df.schema) == {"HV": 9}


def test_only_versions_that_a_manifest_names_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 5):
        df = spark.range(n).selectExpr("'HV' AS region", "'des25' AS suffix", "CAST(id AS STRING) AS lopenr")
        write_table(df, path)
    assert len(list((tmp_path / "t").glob("version-*"))) == 2
    assert sorted(p.name for p in (tmp_path / "t/manifests").glob("*.json")) == ["00000003.json", "00000004.json"]
    assert table_rows(spark, path, df.schema) == {"HV": 4}


def test_a_manifest_is_not_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    _publish(spark, path, {("des25", "HV"): "version-a"}, 1)
    with pytest.raises(OSError, match="meanwhile"):
        _publish(spark, path, {("des25", "HV"): "version-b"}, 1)
    assert "version-a" in (tmp_path / "t/manifests/00000001.json").read_text()


def test_superseded_cache_entries_go(spark, options, tmp_path):
    cached = replace(options, cache_dir=str(tmp_path / "cache"))
    other_way = replace(cached, trim_ids=True)
    source = tmp_path / "in/HV/RHF_HV_des25.csv"
    put(tmp_path / "in/HMN/RHF_HMN_des25.csv", "NPRId\n7\n")
    for n, how in ((1, cached), (2, cached), (2, other_way), (3, cached)):
        put(source, "NPRId\n" + " 1\n" * n)
        os.utime(source, (n * 1000, n * 1000))
        assert load_reports(spark, how).rows.count() == n + 1
    left = sorted(p.parent for p in (tmp_path / "cache").rglob("_COLUMNS"))
    of_source = [p for p in left if "region=HV" in str(p)]
    assert len(of_source) == 2 and len(left) == 4  # one for each way of reading
    assert sorted(spark.read.parquet(str(p)).count() for p in of_source) == [2, 3]


def test_checks_of_files_can_only_warn(spark, options, tmp_path):
    put(tmp_path / "in/HV/RHF_HV_des25.csv", "person\n1\n")
    put(tmp_path / "in/HMN/RHF_HMN_des25.csv", "OF1;NPRId\nÃ¸;1\n;2\n")
    (tmp_path / f"in/{HSO}").mkdir()
    lenient = replace(
        options, warn_only=("missing_input", "missing_key", "mojibake_in"), drop_position=1,
        fail_on_mojibake=True, repair_mojibake=False,
    )
    for how in (lenient, replace(lenient, cache_dir=str(tmp_path / "cache")), replace(lenient, cache_dir=str(tmp_path / "cache"))):
        reports = load_reports(spark, how)
        assert rows(reports, "NPRId") == [("1",), ("2",)]
        assert sorted((g["gate"], g["region"], g["failures"]) for g in reports.gates) == [
            ("column_kept", "HMN", 1), ("missing_input", HSO, 1), ("missing_key", "HV", 1), ("mojibake_in", "HMN", 1),
        ]
    with pytest.raises(MissingInput):
        load_reports(spark, replace(lenient, warn_only=("missing_key", "mojibake_in")))
    with pytest.raises(MissingKeyColumn):
        load_reports(spark, replace(lenient, warn_only=("missing_input", "mojibake_in")))


def test_a_month_without_answers_can_only_warn(spark, tmp_path):
    put(tmp_path / "NPRId_RHF_Pakkeforløp_des25_lnr.csv", "1;10\n")
    assert missing_returns(spark, str(tmp_path), ["des25", "jan26"]) == ["jan26"]
    found = read_returns(spark, str(tmp_path), ["des25", "jan26"], skip_missing=True)
    assert [tuple(r) for r in found.collect()] == [("des25", "1", "10")]
    assert read_returns(spark, str(tmp_path), ["jan26"], skip_missing=True).collect() == []
