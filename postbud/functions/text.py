"""Cell and header text: carriage returns, blanks, transliteration, encoding repair."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from postbud.functions.predicates import has_mojibake

NBSP = "\u00a0"

WHITE_SPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace() and not 0x1C <= code <= 0x1F)


def _plain_letters() -> tuple[dict[str, str], dict[str, str]]:
    """Accented Latin letters -> ASCII, split in one-letter and longer replacements."""
    single = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L"}
    longer = {"æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ß": "ss"}
    for code in range(0x00C0, 0x0180):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii():
            single[chr(code)] = base
    return single, longer


ONE_LETTER, MORE_LETTERS = _plain_letters()


def _cp1252_punctuation() -> dict[str, str]:
    """Characters Windows-1252 has at bytes 0x80-0x9F -> the C1 control of the same byte."""
    pairs = {}
    for byte in range(0x80, 0xA0):
        try:
            pairs[bytes([byte]).decode("cp1252")] = chr(byte)
        except UnicodeDecodeError:
            continue
    return pairs


CP1252_TO_C1 = _cp1252_punctuation()


def strip_cr(c: Column) -> Column:
    return F.replace(c, F.lit("\r"), F.lit(""))


def strip_semicolons(c: Column) -> Column:
    return F.replace(c, F.lit(";"), F.lit(""))


def nbsp_to_space(c: Column) -> Column:
    return F.translate(c, NBSP, " ")


def trim_blanks(c: Column) -> Column:
    """Trim any white space, not only the space character."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def to_ascii(c: Column) -> Column:
    c = F.translate(c, "".join(ONE_LETTER), "".join(ONE_LETTER.values()))
    for letter, plain in MORE_LETTERS.items():
        c = F.replace(c, F.lit(letter), F.lit(plain))
    return c


def header_key(c: Column) -> Column:
    """Header text reduced to ``[a-z0-9]``, the form the alias table is written in."""
    return F.regexp_replace(F.lower(to_ascii(c)), "[^a-z0-9]+", "")


def header_key_text(name: str) -> str:
    """``header_key`` for a header that is already on the driver."""
    table = str.maketrans({**ONE_LETTER, **MORE_LETTERS})
    return re.sub("[^a-z0-9]+", "", name.translate(table).lower())


def clean_header_text(name: str) -> str:
    return name.replace(NBSP, " ").removeprefix("\ufeff").strip()


def decode_cp1252(c: Column) -> Column:
    """Windows-1252 text that was read as ISO-8859-1."""
    decoded = F.translate(c, "".join(CP1252_TO_C1.values()), "".join(CP1252_TO_C1))
    return F.when(F.octet_length(c) > F.length(c), decoded).otherwise(c)


def repair_mojibake(c: Column) -> Column:
    """Undo UTF-8 text having been read as Windows-1252.

    The cell goes back to the bytes it was read from, which are then read as UTF-8. A cell
    whose characters never were single bytes, or whose bytes are not UTF-8, stays as it is.
    """
    bytes_as_text = F.translate(c, "".join(CP1252_TO_C1), "".join(CP1252_TO_C1.values()))
    one_byte_each = bytes_as_text.rlike(r"^[\x00-\xFF]*$")
    raw = F.when(one_byte_each, F.encode(bytes_as_text, "ISO-8859-1"))
    repaired = F.try_validate_utf8(raw.cast("string"))
    return F.when(has_mojibake(c), F.coalesce(repaired, c)).otherwise(c)


def garble(c: Column) -> Column:
    """UTF-8 text read as ISO-8859-1, the fault ``repair_mojibake`` undoes."""
    return F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
