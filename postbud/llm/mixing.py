"""Mix sources to target weights, in DataFrame functions only.

Sources in order of their code points (null last) weigh 5, 2, 1, 5, 2, ... and share the sum of all
sizes by weight. A target stops at ``MAX_COPIES`` times its source's size, and what it leaves is
shared again by weight: target = least(3 size, level * weight), where ``level`` is found by taking
sources in order of size / weight. The rate target / size gives every document floor(rate) copies,
plus one with probability rate - floor(rate) by a hash of its name and ``seed``.

A document's name is its doc_id. Without one it is the hash of its text and its number among the rows of
its source that lack a doc_id and have this text. Such rows are numbered by task, and tasks by a running sum of one row per
task and text, so copies of one text that are a third of the table are not one task's. Their numbers
run from 1 without gaps, so reruns take equal texts equally often; which of several rows of one text gets which number is
open.

The size of a text is its number of runs of anything but ASCII white space; null has none. Tokens
are summed per source with partial sums, so one source may hold most rows; the windows run over one
row a source. Rows that repeat a doc_id draw alike. Sources of size 0 have target 0. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postbud.session import stage

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source``, ``source_size``, ``target``, ``rate``: a row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("long")).withColumn("cap", MAX_COPIES * F.col("source_size"))
    # In order of cap / weight: if all before are at their caps, the level that the rest would share.
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    per = per.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    # The first one that is not at its cap; sources of equal ratio share one fate.
    per = per.withColumn("place", F.row_number().over(by_ratio))
    shared = F.min(F.when(F.col("open"), F.struct("place", "level"))).over(every)["level"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(shared * F.col("weight"), F.col("cap").cast("double")))
    return per.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    )


def copies_of(name: Column, rate: Column, seed: str = SEED) -> Column:
    draw = F.md5(F.concat(F.lit(f"{seed}:"), name))
    unit = F.conv(F.substring(draw, 1, 8), 16, 10).cast("double") / float(1 << 32)
    return (F.floor(rate) + F.when(unit < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def named(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_name``, and without ``_digest``, the text's hash."""
    known = rows.where("doc_id IS NOT NULL").withColumn("_name", F.col("doc_id").cast("string")).drop("_digest")
    if rows.where("doc_id IS NULL").isEmpty():
        return known
    unknown = rows.where("doc_id IS NULL").withColumns({"_task": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    unknown = stage(unknown, "unnamed")
    of_text = [F.col("source").cast("string").alias("_of"), "_digest"]
    per_task = unknown.groupBy(*of_text, "_task").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_of", "_digest").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("_of", "_digest", "_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    before = stage(before, "before").withColumnsRenamed({"_digest": "_of_digest", "_task": "_of_task"})
    same = (
        F.col("source").cast("string").eqNullSafe(F.col("_of"))
        & (F.col("_digest") == F.col("_of_digest")) & (F.col("_task") == F.col("_of_task"))
    )
    in_task = Window.partitionBy(F.col("source").cast("string"), "_digest", "_task").orderBy("_at")
    counted = unknown.withColumn("_number", F.row_number().over(in_task)).join(before, same)
    name = F.concat_ws(":", F.lit("null"), "_digest", F.col("_before") + F.col("_number"))
    return known.unionByName(counted.withColumn("_name", name).select(*known.columns))


def _digest(text: Column) -> Column:
    return F.when(F.col("doc_id").isNull(), F.md5(F.coalesce(text, F.lit(""))))


def _rates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    sizes = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size"), _digest(F.col("text")).alias("_digest")
    )
    sizes = stage(sizes, "sizes")
    rates = stage(targets(sizes), "rates").withColumnRenamed("source", "_source")
    return sizes, rates


def mixture(docs: DataFrame) -> DataFrame:
    """A row per document: its size, its source's size and target, and the words the mix takes."""
    sizes, rates = _rates(docs)
    joined = named(sizes).join(rates, F.col("source").eqNullSafe(F.col("_source")))
    copies = copies_of(F.col("_name"), F.col("rate"))
    return joined.select(
        F.col("doc_id").cast("long"), "size", "source_size", "target", (copies * F.col("size")).alias("taken")
    )


def mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it, with its columns."""
    columns = docs.columns
    _, rates = _rates(docs)
    docs = named(docs.withColumn("_digest", _digest(F.col("text"))))
    joined = docs.join(rates.select("_source", F.col("rate").alias("_rate")), docs["source"].cast("string").eqNullSafe(F.col("_source")))
    copies = joined.withColumn("_copies", copies_of(F.col("_name"), F.col("_rate"))).where("_copies > 0")
    return copies.select(*columns, F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))).alias("_")).drop("_")


ORACLE = """
WITH sizes AS (
  SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')) || ':'
      || row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, '')))) AS name,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (ARRAY[5, 2, 1])[((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sizes GROUP BY source
), levels AS (
  SELECT *, 3 * source_size AS cap,
    ((SELECT sum(size) FROM sizes) - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, encode(source) NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (ORDER BY 3 * source_size / weight, encode(source) NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
    row_number() OVER (ORDER BY 3 * source_size / weight, encode(source) NULLS LAST) AS place
  FROM per
), shared AS (
  SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= cap
), targets AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(shared.level * weight, cap::DOUBLE)) AS target
  FROM levels CROSS JOIN shared
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN
    ('0x' || substr(md5('mix-1:' || name), 1, 8))::UBIGINT / 4294967296.0
    < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sizes JOIN rates ON sizes.source IS NOT DISTINCT FROM rates.source
"""
