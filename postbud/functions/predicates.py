"""The predicates that decide whether a cell counts as present."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "NPRId"
NUMBER = "lopenr"
NULL_TOKEN = "NULL"

# Characters that UTF-8 text shows when it was once read as a one-byte encoding.
MOJIBAKE_MARKS = ("Ã", "Â")


def is_valid_key(c: Column) -> Column:
    """A person key that can be requested and delivered; a repeated header word is not."""
    return c.isNotNull() & ~c.isin("", KEY, NULL_TOKEN)


def is_missing(c: Column) -> Column:
    """Missing in any of its three spellings."""
    return c.isNull() | c.isin("", NULL_TOKEN)


def is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def has_mojibake(c: Column) -> Column:
    first, second = MOJIBAKE_MARKS
    return F.coalesce(c.contains(first) | c.contains(second), F.lit(False))


def column_or_null(df: DataFrame, name: str) -> Column:
    """The column if the table has it, else a NULL string."""
    present = name.lower() in {c.lower() for c in df.columns}
    return F.col(name) if present else F.lit(None).cast("string")
