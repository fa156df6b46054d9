from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postbud.functions.dates import month_suffix, parse_any_date
from postbud.functions.numbers import cast_lost, to_integer
from postbud.functions.predicates import has_mojibake, is_blank, is_missing, is_valid_key
from postbud.functions.text import (
    blank_to_null,
    clean_header_text,
    decode_cp1252,
    header_key,
    header_key_text,
    nbsp_to_space,
    repair_mojibake,
    strip_cr,
    strip_semicolons,
    to_ascii,
    trim_blanks,
)
from postbud.layout import DELIVERY_COLUMNS, HEADER_ALIASES, LOCATION_OVERRIDES, MONTHS

CELLS = [None, "", "NULL", "NPRId", " 12", "12"]


def test_fixed_values():
    assert len(DELIVERY_COLUMNS) == len(set(DELIVERY_COLUMNS)) == 37
    assert DELIVERY_COLUMNS[0] == "lopenr" and DELIVERY_COLUMNS[-1] == "AnsiennDato"
    assert len(MONTHS) == 12 and len(LOCATION_OVERRIDES) == 4
    assert set(HEADER_ALIASES.values()) == set(DELIVERY_COLUMNS) - {"lopenr"} | {"NPRId", "MottaksDato"}
    assert all(k == header_key_text(k) for k in HEADER_ALIASES)


def test_predicates(apply):
    assert apply(is_valid_key, CELLS) == [False, False, False, False, True, True]
    assert apply(is_missing, CELLS) == [True, True, True, False, False, False]
    assert apply(is_blank, CELLS) == [True, True, False, False, False, False]
    assert apply(has_mojibake, [None, "", "SÃO", "Â", "æøå"]) == [False, False, True, True, False]


def test_cell_cleaning(apply):
    assert apply(strip_cr, ["a\rb\r", "\r", None]) == ["ab", "", None]
    assert apply(strip_semicolons, ["55;", ";;", "5"]) == ["55", "", "5"]
    assert apply(trim_blanks, [" \t12 \n", " x ", "", None, "a b"]) == ["12", "x", "", None, "a b"]
    assert apply(blank_to_null, ["", "a", None]) == [None, "a", None]
    assert apply(nbsp_to_space, ["a b"]) == ["a b"]
    assert apply(to_ascii, ["Fødsels Åæ éüßœ"]) == ["Fodsels Aae eussoe"]


def test_header_keys_agree(apply):
    headers = ["Fødsels Dato", " NPR Id ", "Institusjon_navn", "textbox74", "År", "Pakkeforløp Navn1", ""]
    keys = ["fodselsdato", "nprid", "institusjonnavn", "textbox74", "ar", "pakkeforlopnavn1", ""]
    assert [header_key_text(h) for h in headers] == keys
    assert apply(header_key, headers) == keys
    assert clean_header_text("﻿NPR Id ") == "NPR Id"


def test_integers(apply):
    texts = ["12", " 12 ", "12.7", "-12.7", "1e3", "99999999999", "x", "", None, "12d", "NaN", "0x1A", ".5", "+7"]
    assert apply(to_integer, texts) == [12, 12, 12, -12, 1000, None, None, None, None, None, None, None, 0, 7]
    assert apply(cast_lost, ["12", "x", "", None, " ", "99999999999"]) == [False, True, False, False, True, True]


@pytest.mark.parametrize(
    "text",
    [
        "2025-12-01", "20251201", "01.12.2025", "1.12.2025", "01122025", "01-12-2025 10:11:12",
        "2025.12.01 10:11:12", "2025/12/01", "1/12/2025", "2025-12-01T10:11:12", " 01.12.2025 ", "20251201 10:11:12",
    ],
)
def test_dates(apply, text):
    assert apply(parse_any_date, [text]) == [date(2025, 12, 1)]


def test_dates_between_tabs(apply):
    assert apply(parse_any_date, ["\t01.12.2025\t"]) == [date(2025, 12, 1)]


def test_no_dates(apply):
    junk = ["x", "", None, "30.02.2025", "2025-13-01", "01.12.25", "2025-12-01 25:00:00", "2025-12", "20251301x", "12025-12-01"]
    assert apply(parse_any_date, junk) == [None] * len(junk)


def test_eight_digits_fall_back_to_day_first(apply):
    assert apply(parse_any_date, ["31122025", "12102010"]) == [date(2025, 12, 31), date(2010, 10, 12)]


def test_month_suffix(apply):
    days = [date(2025, 12, 1), date(2026, 1, 31), date(1999, 5, 17)]
    assert apply(month_suffix, days, "date") == ["des25", "jan26", "mai99"]


def test_repair(apply):
    broken = ["PakkeforlÃ¸p", "Ã… Ã˜ Ã¦", "SÃO", "Â", "pris 5 â‚¬ Ã¸", "日本 Ã¸", None, "", "helt fin æøå"]
    right = ["Pakkeforløp", "Å Ø æ", "SÃO", "Â", "pris 5 € ø", "日本 Ã¸", None, "", "helt fin æøå"]
    assert apply(repair_mojibake, broken) == right


def test_cp1252(apply):
    raw = bytes(range(0x80, 0x100))
    read = raw.decode("latin-1")
    expected = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in raw)
    assert apply(decode_cp1252, [read]) == [expected]


latin = st.text(st.characters(min_codepoint=0x20, max_codepoint=0xFF, exclude_categories=["Cc"]), max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(latin, min_size=20, max_size=60))
def test_repair_undoes_garbling(apply, texts):
    garbled = [t.encode().decode("latin-1") for t in texts]
    # A text that looks garbled to begin with may be taken for one; leave those out.
    plain = [(g, t) for g, t in zip(garbled, texts) if not set(t) & set("ÃÂ")]
    assert apply(repair_mojibake, [g for g, _ in plain] or [""]) == ([t for _, t in plain] or [""])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(max_size=15), min_size=20, max_size=60))
def test_nothing_fails_on_any_text(apply, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    for expression in (to_integer, parse_any_date, repair_mojibake, header_key, trim_blanks):
        assert len(apply(expression, texts)) == len(texts)


def test_conditions_keep_nulls_apart(spark):
    df = spark.createDataFrame([(None,), ("a",)], "v string")
    assert df.where(is_valid_key(F.col("v")) | is_missing(F.col("v"))).count() == 2
