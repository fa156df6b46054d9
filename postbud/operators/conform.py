"""From drifting headers to one layout: renaming, filling, dropping, typing columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postbud.functions.numbers import to_integer
from postbud.functions.predicates import KEY, NUMBER, is_blank, is_missing
from postbud.functions.text import clean_header_text, header_key_text
from postbud.layout import HEADER_ALIASES
from postbud.options import DeliveryOptions

# Columns the engine adds itself; a source column of the same name is set aside.
RESERVED = ("region", "suffix", "key")


@dataclass(frozen=True)
class HeaderPlan:
    """Output name of every source column, by position, and what could not be renamed."""

    names: tuple[str, ...]
    collisions: tuple[tuple[str, str], ...]


class MissingKeyColumn(ValueError):
    pass


def plan_header(
    header: Sequence[str],
    aliases: Mapping[str, str] = HEADER_ALIASES,
    policy: str = "unique",
) -> HeaderPlan:
    """Decide the column names of one header.

    An alias takes effect if exactly one header reduces to it (``unique``) or for the first
    one that does (``first``). If several aliases lead to one column, the alias listed first
    wins; the other columns keep their own names and are reported. Names that would clash
    without regard to case get their position appended.
    """
    cleaned = [clean_header_text(h) for h in header]
    keys = [header_key_text(h) for h in cleaned]
    renamed: dict[int, str] = {}
    collisions = []
    for key, target in aliases.items():
        hits = [i for i, k in enumerate(keys) if k == key]
        if not hits or (policy == "unique" and len(hits) > 1):
            continue
        if target in renamed.values():
            collisions.append((cleaned[hits[0]], target))
        else:
            renamed[hits[0]] = target

    taken = {name.lower() for name in renamed.values()} | set(RESERVED)
    own = [h.lower() for h in cleaned]
    names = []
    for i, text in enumerate(cleaned):
        name = renamed.get(i)
        if name is None:
            repeated = own.count(own[i]) > 1
            name = text if text and not repeated and own[i] not in taken else f"{text}...{i + 1}"
            taken.add(name.lower())
        names.append(name)
    return HeaderPlan(tuple(names), tuple(collisions))


def require_key(columns: Iterable[str], label: str) -> None:
    if KEY not in columns:
        raise MissingKeyColumn(f"no column {KEY} in {label}; columns: {', '.join(columns)}")


def rename_headers(df: DataFrame, options: DeliveryOptions) -> DataFrame:
    """Give the columns of a table their standard names."""
    plan = plan_header(df.columns, options.header_aliases, options.alias_policy)
    require_key(plan.names, "the table")
    return df.toDF(*plan.names)


def add_location_columns(df: DataFrame, token: str | None = "NULL") -> DataFrame:
    """Municipality and district exist in every conformed table."""
    absent = missing_columns(df.columns, ("KommuneNr", "BydelNr"))
    return df.withColumns({c: F.lit(token).cast("string") for c in absent})


def conform(df: DataFrame, options: DeliveryOptions) -> DataFrame:
    return add_location_columns(rename_headers(df, options), options.absent_location_token)


def union_regions(tables: Iterable[DataFrame]) -> DataFrame:
    """All rows by column name; a column a table lacks is NULL there."""
    tables = iter(tables)
    result = next(tables)
    for table in tables:
        result = result.unionByName(table, allowMissingColumns=True)
    return result


def missing_columns(columns: Iterable[str], wanted: Iterable[str]) -> list[str]:
    have = set(columns)
    return [c for c in wanted if c not in have]


def missing_column_report(
    spark: SparkSession, present: Mapping[tuple[str, str], Iterable[str]], wanted: Sequence[str]
) -> DataFrame:
    """One row per region, month and wanted column that its export does not have."""
    rows = [
        (region, suffix, column)
        for (region, suffix), columns in sorted(present.items())
        for column in missing_columns(columns, wanted)
    ]
    return spark.createDataFrame(rows, "region string, suffix string, missing_column string")


def column_fill(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """For every column, whether any cell is filled, in a single aggregate."""
    columns = [c for c in (columns or df.columns) if c not in by]
    return df.groupBy(*by).agg(*[F.max(~is_blank(_quoted(c).cast("string"))).alias(c) for c in columns])


def empty_columns(df: DataFrame) -> list[str]:
    """Columns without a filled cell; a table without rows has none."""
    filled = column_fill(df).first()
    return [c for c in df.columns if filled[c] is False]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    return df.drop(*empty_columns(df))


def drop_column_at_if_empty(df: DataFrame, position: int) -> tuple[DataFrame, bool]:
    """Drop the column at a 1-based position if it is empty; tells whether it was dropped."""
    if len(df.columns) < position:
        return df, False
    name = df.columns[position - 1]
    if empty_columns(df.select(_quoted(name))):
        return df.drop(name), True
    return df, False


def rescue_number(df: DataFrame, broken: str = "enr") -> DataFrame:
    """Use a number column whose name lost its first letters to a byte order mark."""
    if broken not in df.columns:
        return df
    if NUMBER not in df.columns:
        return df.withColumnRenamed(broken, NUMBER)
    number = F.when(is_missing(F.col(NUMBER)), F.col(broken)).otherwise(F.col(NUMBER))
    return df.withColumn(NUMBER, number).drop(broken)


def output_cell(c: Column, name: str, options: DeliveryOptions) -> Column:
    """One output cell: an integer where asked for, else text with the token for a blank."""
    if name in options.integer_columns:
        return to_integer(c.cast("string")).alias(name)
    text = c.cast("string")
    return F.when(is_blank(text), F.lit(options.missing_token)).otherwise(text).alias(name)


def output_shape(df: DataFrame, options: DeliveryOptions, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the output columns in order, after the ``keep`` columns."""
    have = set(df.columns)
    shaped = [
        output_cell(F.col(c) if c in have else F.lit(None), c, options) for c in options.columns
    ]
    return df.select(*keep, *shaped)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
