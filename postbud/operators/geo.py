"""Municipality and district: latest known location, overrides, filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postbud.functions.predicates import KEY, is_missing, is_valid_key
from postbud.operators.ids import RUN_KEY

# So many keys at most are written into a filter.
FEW_KEYS = 1000


def ids_missing_municipality(report: DataFrame) -> DataFrame:
    """Valid keys that lack a municipality on some row of a month, in any region."""
    return (
        report.where(is_valid_key(F.col(KEY)) & is_missing(F.col("KommuneNr")))
        .select(*RUN_KEY)
        .distinct()
    )


def keys_missing_municipality(profile: DataFrame) -> DataFrame:
    """The same keys from a key profile, without going through the report again."""
    return (
        profile.where(is_valid_key(F.col(KEY)) & (F.col("n_no_kommune") > 0)).select(*RUN_KEY).distinct()
    )


def latest_location(history: DataFrame) -> DataFrame:
    """The row of the latest year per key; equal years go by municipality, then district.

    An aggregate rather than a ranked window: each task keeps one row per key before the
    shuffle, so the length of one person's history does not matter.
    """
    newest_first = F.struct(
        F.col("aar").isNull().alias("no_year"),
        (-F.col("aar").cast("long")).alias("age"),
        F.col("komnrhjem2"),
        F.col("bydel2"),
    )
    return (
        history.groupBy(KEY)
        .agg(F.min(newest_first).alias("first"))
        .select(
            KEY,
            "first.komnrhjem2",
            "first.bydel2",
            (-F.col("first.age")).cast("int").alias("aar"),
        )
    )


def apply_overrides(fixes: DataFrame, overrides: DataFrame) -> DataFrame:
    """Replace the municipality where key and latest year match an override.

    No hint is given: a short inline table is broadcast because its size is known, and a
    long one is joined by shuffle.
    """
    replacement = overrides.select(KEY, "aar", F.col("komnrhjem2").alias("komnrhjem2_override"))
    return fixes.join(replacement, [KEY, "aar"], "left").select(
        *fixes.columns[: fixes.columns.index("komnrhjem2")],
        F.coalesce("komnrhjem2_override", "komnrhjem2").alias("komnrhjem2"),
        *fixes.columns[fixes.columns.index("komnrhjem2") + 1 :],
    )


def needed_history(history: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of needed keys only, cut where the history is read.

    The range of the keys, and the keys themselves if they are few, go to the scan as literals: parquet
    skips row groups by them, a database by its index, where ``numPartitions`` splits the reading. What comes
    through is semi-joined, to which Spark adds a Bloom filter where the sizes make it worth. ``keys`` holds distinct
    keys; as they are looked at here, it should be a written table.
    """
    few = [r[0] for r in keys.limit(FEW_KEYS + 1).collect()]
    if not few:
        return history.limit(0)
    if len(few) <= FEW_KEYS:
        history = history.where(F.col(KEY).isin(few))
    else:
        least, most = keys.agg(F.min(KEY), F.max(KEY)).first()
        history = history.where(F.col(KEY).between(least, most))
    return history.join(keys, KEY, "left_semi")


def location_fixes(history: DataFrame, needed: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Latest location of every needed key, once per month that needs it.

    Both sides hold a key once (per month), so the join cannot be skewed.
    """
    latest = latest_location(history)
    if overrides is not None:
        latest = apply_overrides(latest, overrides)
    return needed.select(*RUN_KEY).join(latest, KEY).select(*RUN_KEY, "komnrhjem2", "bydel2", "aar")


def filled_municipality() -> Column:
    k = F.col("KommuneNr")
    return F.when(is_missing(k), F.col("komnrhjem2")).otherwise(k)


def filled_district(mode: str = "original") -> Column:
    """District from the lookup where its municipality is the one of the row.

    ``original`` compares the municipality as it came in and takes any spelling of a missing
    district; ``filled`` compares the filled municipality and takes only an absent district.
    """
    k, b = F.col("KommuneNr"), F.col("BydelNr")
    if mode == "original":
        fits = ~is_missing(k) & (k == F.col("komnrhjem2")) & is_missing(b)
    else:
        fits = (filled_municipality() == F.col("komnrhjem2")) & b.isNull()
    return F.when(fits, F.col("bydel2")).otherwise(b)


def fill_location(report: DataFrame, fixes: DataFrame, mode: str = "original") -> DataFrame:
    """Fill both columns from values as they came in."""
    joined = report.join(fixes.select(*RUN_KEY, "komnrhjem2", "bydel2"), RUN_KEY, "left")
    return joined.withColumns(
        {"KommuneNr": filled_municipality(), "BydelNr": filled_district(mode)}
    ).drop("komnrhjem2", "bydel2")
