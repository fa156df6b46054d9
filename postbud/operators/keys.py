"""The key table: all that a run knows of a person in a month, joined once.

Profile, returned numbers and locations meet in one aggregate by month and key, and one more aggregate
over that table answers every count of the run: gates, audit trail, sizes of deliveries, groups
without a year. Each has partial sums before its shuffle, so no key, month or region is too large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postbud.functions.numbers import cast_lost
from postbud.functions.predicates import KEY, NUMBER, is_missing, is_valid_key
from postbud.operators.ids import GROUP, RUN_KEY

GATE_SCHEMA = "gate string, suffix string, region string, failures long, sample string"


def key_table(profile: DataFrame, id_map: DataFrame, fixes: DataFrame | None = None) -> DataFrame:
    """A row per month and key.

    ``places`` holds the profile's counts per region, ``answers`` and ``blank_answers`` how often the key was
    returned at all and without a number, ``lopenr`` its usable number, ``returned`` whatever came back,
    ``fix`` its location.
    """
    counts = [c for c in profile.columns if c not in (*GROUP, KEY)]
    parts = profile.select(*RUN_KEY, F.struct("region", *counts).alias("place"))
    answers = id_map.select(*RUN_KEY, F.lit(1).alias("answer"), F.col(NUMBER).alias("number"))
    parts = parts.unionByName(answers, allowMissingColumns=True)
    if fixes is None:
        parts = parts.withColumn("fix", F.lit(None).cast("struct<komnrhjem2:string,bydel2:string>"))
    else:
        located = fixes.select(*RUN_KEY, F.struct("komnrhjem2", "bydel2").alias("fix"))
        parts = parts.unionByName(located, allowMissingColumns=True)
    number = F.col("number")
    usable = F.when(is_valid_key(F.col(KEY)) & ~is_missing(number), number)
    return parts.groupBy(*RUN_KEY).agg(
        F.collect_list("place").alias("places"),
        F.count("answer").alias("answers"),
        F.count_if(F.col("answer").isNotNull() & is_missing(number)).alias("blank_answers"),
        F.max(usable).alias(NUMBER),
        F.max(number).alias("returned"),
        F.max("fix").alias("fix"),
    )


def lookup_of(keys: DataFrame, keep_unnumbered: bool = False) -> DataFrame:
    """Run number and location by month and key, for the join with the report."""
    wanted = F.col(NUMBER).isNotNull()
    if keep_unnumbered:
        wanted = wanted | F.col("fix").isNotNull()
    return keys.where(wanted).select(*RUN_KEY, NUMBER, "fix.komnrhjem2", "fix.bydel2")


def unmapped_keys(keys: DataFrame) -> DataFrame:
    """Needed keys without a usable number, with what was returned for them."""
    needed = is_valid_key(F.col(KEY)) & (F.size("places") > 0)
    return keys.where(needed & F.col(NUMBER).isNull()).select(*RUN_KEY, F.col("returned").alias(NUMBER))


def _duplicates() -> Column:
    key = F.col(KEY)
    return (key.isNotNull() & (key != "") & (F.col("answers") > 1)).cast("long")


def _unmapped() -> Column:
    """Answers without a number, or one for a needed key that got no answer."""
    needed = is_valid_key(F.col(KEY)) & (F.size("places") > 0)
    return F.when(needed, F.when(F.col("answers") == 0, 1).otherwise(F.col("blank_answers"))).otherwise(0).cast("long")


def totals(keys: DataFrame, integer_columns: Sequence[str] = ()) -> DataFrame:
    """Every count of a run: a row per month and region, and one per month with ``region`` NULL."""
    place = keys.schema["places"].dataType.elementType.names
    casts = [c for c in place if c.startswith(("n_lost_", "n_filled_"))]
    number, valid, asked = F.col(NUMBER), is_valid_key(F.col(KEY)), F.size("places") > 0
    own = [f"n_{kind}_{NUMBER}" for kind in ("filled", "lost")] if NUMBER in integer_columns else []
    of_number = {f"n_filled_{NUMBER}": number.isNotNull(), f"n_lost_{NUMBER}": cast_lost(number)}

    month = {
        "n_rows": F.aggregate("places", F.lit(0).cast("long"), lambda n, p: n + p["n_rows"]),
        "n_keys": asked.cast("long"),
        "n_valid": (asked & valid).cast("long"),
        "answers": F.col("answers"),
        "duplicates": _duplicates(),
        "unmapped": _unmapped(),
        "no_location": (valid & F.exists("places", lambda p: p["n_no_kommune"] > 0)).cast("long"),
        "located": F.col("fix").isNotNull().cast("long"),
    }
    region = ["rows", "missing_kommune", "mojibake", "n_year", *casts, *own]
    zero = F.lit(0).cast("long")

    def of_place(p: Column) -> Column:
        delivered = valid & (number.isNotNull() | p["own_number"])

        def counted(c: Column) -> Column:
            return F.when(delivered, c).otherwise(0).cast("long")

        values = {
            "rows": counted(p["n_rows"]),
            "missing_kommune": counted(F.when(is_missing(F.col("fix.komnrhjem2")), p["n_no_kommune"]).otherwise(0)),
            "mojibake": counted(p["n_mojibake"]),
            "n_year": counted(p["n_year"]),
            **{c: counted(p[c]) for c in casts},
            **{c: counted(F.when(of_number[c], p["n_rows"]).otherwise(0)) for c in own},
        }
        rows = {c: p["n_rows"] if c == "n_rows" else zero for c in month}
        return F.struct(p["region"].alias("region"), *[c.alias(n) for n, c in {**rows, **values}.items()])

    of_month = F.struct(
        F.lit(None).cast("string").alias("region"), *[c.alias(n) for n, c in month.items()], *[zero.alias(c) for c in region]
    )
    each = keys.select("suffix", F.inline(F.concat(F.array(of_month), F.transform("places", of_place))))
    return each.groupBy("suffix", "region").agg(*[F.sum(c).alias(c) for c in [*month, *region]])


def counts_of(totals: DataFrame) -> DataFrame:
    """What each delivery will hold; regions and months without a row to deliver are left out."""
    kept = [c for c in totals.columns if c in ("rows", "missing_kommune", "mojibake") or c.startswith(("n_lost_", "n_filled_"))]
    return totals.where("region IS NOT NULL AND rows > 0").select(*GROUP, *kept)


def without_year(totals: DataFrame) -> DataFrame:
    """Region and month pairs none of whose delivered rows has a year."""
    return totals.where("region IS NOT NULL AND rows > 0 AND n_year = 0").select(*GROUP, F.lit(True).alias("no_year"))


def gates_of(totals: DataFrame, keys: DataFrame, examples: int = 10) -> DataFrame:
    """Failed checks of the mapping and of the output, in the one schema that all gates have."""
    lost = [c for c in totals.columns if c.startswith("n_lost_")]
    of_month = F.col("region").isNull()
    checks = {
        "map_empty": F.when(of_month & (F.col("n_keys") > 0) & (F.col("answers") == 0), 1),
        "map_duplicates": F.when(of_month, F.col("duplicates")),
        "unmapped": F.when(of_month, F.col("unmapped")),
        "mojibake_out": F.when(~of_month, F.col("mojibake")),
        **{f"cast_loss:{c.removeprefix('n_lost_')}": F.when(~of_month, F.col(c)) for c in lost},
    }

    def listed(values: dict[str, Column]) -> Column:
        pairs = [F.struct(F.lit(g).alias("gate"), n.cast("long").alias("failures")) for g, n in values.items()]
        return F.inline(F.array(*pairs))

    failed = totals.select("suffix", "region", listed(checks)).where("failures > 0")
    # Only the first examples of each month leave a task.
    offending = keys.select("suffix", KEY, listed({"map_duplicates": _duplicates(), "unmapped": _unmapped()}))
    offending = offending.where("failures > 0").select(
        "suffix", "gate", KEY, F.explode(F.sequence(F.lit(1), F.least("failures", F.lit(examples)).cast("int")))
    )
    place = F.row_number().over(Window.partitionBy("suffix", "gate").orderBy(KEY))
    sample = F.array_join(F.array_sort(F.collect_list(KEY)), ", ")
    samples = offending.withColumn("place", place).where(F.col("place") <= examples).groupBy("suffix", "gate").agg(sample.alias("sample"))
    return failed.join(samples, ["suffix", "gate"], "left").select("gate", "suffix", "region", "failures", "sample")


def metrics_of(totals: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The audit trail: a row per month, region and count; no more than a projection of the totals.

    ``groups`` lists regions and months whose deliveries are counted also if they are empty.
    """
    casts = [c for c in totals.columns if c.startswith(("n_lost_", "n_filled_"))]
    here = F.col("region").isNotNull()
    filled = F.col("rows") > 0
    if groups is not None:
        # One row per region and month, so this side always fits.
        totals = totals.join(F.broadcast(groups.withColumn("_listed", F.lit(True))), GROUP, "full").na.fill(0)
        filled = filled | F.col("_listed")
    month, some = ~here & (F.col("n_keys") > 0), ~here
    metrics = {
        "input_rows": (here & (F.col("n_rows") > 0), "n_rows"),
        "total_rows": (month, "n_rows"),
        "distinct_ids": (month, "n_keys"),
        "request_rows": (month, "n_valid"),
        "return_rows": (some & (F.col("answers") > 0), "answers"),
        "delivery_rows": (here & filled, "rows"),
        "missing_kommune": (here & filled, "missing_kommune"),
        "missing_kommune_ids": (some & (F.col("no_location") > 0), "no_location"),
        "geo_rows": (some & (F.col("located") > 0), "located"),
        **{c.removeprefix("n_"): (here & filled, c) for c in casts},
    }
    pairs = [
        F.struct(F.lit(name).alias("metric"), F.when(when, F.col(c)).cast("long").alias("value"))
        for name, (when, c) in metrics.items()
    ]
    return totals.select("suffix", "region", F.inline(F.array(*pairs))).where("value IS NOT NULL")
