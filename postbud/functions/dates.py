"""Dates written in many ways, and the month suffix used in file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postbud.functions.text import trim_blanks
from postbud.layout import MONTHS

# Shapes of a date once its separators are hyphens, and the order that makes it ISO.
DATE_SHAPES = (
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})", "$1-$2-$3"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})", "$3-$2-$1"),
    (r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3"),
    (r"^(\d{2})(\d{2})(\d{4})", "$3-$2-$1"),
)
TIME_OF_DAY = r"( +([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d)?$"


def parse_any_date(c: Column) -> Column:
    """First reading that is a date, NULL where none is.

    The text is put in ISO order and cast, as a failed parse by pattern costs an exception.
    """
    text = F.translate(trim_blanks(c), "./_T", "--- ")
    tries = []
    for shape, order in DATE_SHAPES:
        whole = shape + TIME_OF_DAY
        tries.append(F.when(text.rlike(whole), F.regexp_replace(text, whole, order)).try_cast("date"))
    return F.coalesce(*tries)


def month_suffix(c: Column) -> Column:
    """2025-12-01 -> ``des25``."""
    names = F.array(*[F.lit(m) for m in MONTHS])
    return F.concat(F.element_at(names, F.month(c)), F.date_format(c, "yy"))
