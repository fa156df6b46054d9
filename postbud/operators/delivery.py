"""The delivery: numbers attached, location filled, year filled, output layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postbud.functions.dates import parse_any_date
from postbud.functions.predicates import KEY, NUMBER, column_or_null, is_missing, is_valid_key
from postbud.operators.conform import output_shape, rescue_number
from postbud.operators.geo import filled_district, filled_municipality
from postbud.operators.ids import GROUP, RUN_KEY, key_profile, usable_numbers
from postbud.options import DeliveryOptions


def key_lookup(id_map: DataFrame, fixes: DataFrame | None, keep_unnumbered: bool = False) -> DataFrame:
    """Run number and location of a key in one table, one row per month and key."""
    numbers = usable_numbers(id_map).select(*RUN_KEY, NUMBER)
    if fixes is None:
        return numbers
    return numbers.join(
        fixes.select(*RUN_KEY, "komnrhjem2", "bydel2"),
        RUN_KEY,
        "full" if keep_unnumbered else "left",
    )


def delivered_keys(profile: DataFrame, id_map: DataFrame) -> DataFrame:
    """Profile rows whose report rows are delivered."""
    return (
        profile.where(is_valid_key(F.col(KEY)))
        .join(usable_numbers(id_map).select(*RUN_KEY, NUMBER), RUN_KEY, "left")
        .where(F.col(NUMBER).isNotNull() | F.col("own_number"))
    )


def groups_without_year(profile: DataFrame, id_map: DataFrame) -> DataFrame:
    """Region and month pairs none of whose delivered rows has a year."""
    return (
        delivered_keys(profile, id_map)
        .groupBy(*GROUP)
        .agg((F.sum("n_year") == 0).alias("no_year"))
        .where("no_year")
    )


def backfilled_year(no_year: Column, year: Column, start: Column) -> Column:
    """The year of the start date where the whole group has none."""
    return F.when(no_year, F.coalesce(F.year(parse_any_date(start)).cast("string"), year)).otherwise(year)


def deliver(
    report: DataFrame,
    id_map: DataFrame,
    fixes: DataFrame | None,
    options: DeliveryOptions,
    profile: DataFrame | None = None,
    keep: tuple[str, ...] = ("region", "suffix"),
    lookup: DataFrame | None = None,
    no_year: DataFrame | None = None,
) -> DataFrame:
    """All deliveries of a run as one table, the ``keep`` columns before the output layout.

    ``fixes`` is None when missing municipalities are not to be filled. ``profile`` is the key
    profile of the report, ``lookup`` its ``key_lookup`` and ``no_year`` its ``groups_without_year``; a run
    passes those that its key table gives. With a
    staged lookup the wide report goes through one join whose sides are both plain shuffles, and
    only there does AQE split the partition of a key that holds a large share of the rows.
    """
    if no_year is None:
        no_year = groups_without_year(key_profile(report) if profile is None else profile, id_map)
    if lookup is None:
        lookup = key_lookup(id_map, fixes, keep_unnumbered="enr" in report.columns)
    numbered = report.where(is_valid_key(F.col(KEY))).drop(NUMBER).join(lookup, RUN_KEY, "left")
    numbered = rescue_number(numbered).where(~is_missing(F.col(NUMBER)))
    # One row per region and month, so this side always fits.
    flagged = numbered.join(F.broadcast(no_year), GROUP, "left")

    filled = {
        "År": backfilled_year(
            F.coalesce("no_year", F.lit(False)),
            column_or_null(report, "År"),
            column_or_null(report, "StartDato"),
        )
    }
    if fixes is not None:
        filled["KommuneNr"] = filled_municipality()
        filled["BydelNr"] = filled_district(options.district_fill)
    return output_shape(flagged.withColumns(filled), options, keep)
