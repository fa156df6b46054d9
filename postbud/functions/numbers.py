"""Text to integer without ever failing a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postbud.functions.text import trim_blanks

NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_integer(c: Column) -> Column:
    """Trimmed text as a 32-bit integer; a fraction is cut off, anything else gives NULL."""
    text = trim_blanks(c)
    number = F.when(text.rlike(NUMBER_TEXT), text).try_cast("double")
    return number.try_cast("int")


def cast_lost(c: Column) -> Column:
    """True where a filled cell has no integer reading."""
    return c.isNotNull() & (c != "") & to_integer(c).isNull()
