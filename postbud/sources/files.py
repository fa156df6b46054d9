"""Listing, choosing and profiling input files.

Only facts about files come to the driver: paths, times, first lines. There is at most one
export per region and month, so all of these lists are as long as regions times months.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postbud.functions.predicates import MOJIBAKE_MARKS, has_mojibake
from postbud.functions.text import clean_header_text, decode_cp1252, nbsp_to_space
from postbud.options import DeliveryOptions

UTF8 = "UTF-8"
CP1252 = "Windows-1252"
LATIN1 = "ISO-8859-1"
BOM = "\ufeff"
# A line of these alone is blank, as the parser sees it.
CONTROLS = "".join(map(chr, range(0x21)))


@dataclass(frozen=True)
class ExportFile:
    """One chosen export and what its first lines and bytes say about it.

    Parts of an export that begin differently are one of these each.
    """

    path: str
    uri: str
    modified: object
    length: int
    targets: tuple[tuple[str, str], ...]
    delimiter: str
    encoding: str
    has_marks: bool
    broken_lines: bool
    header: tuple[str, ...]
    parts: tuple[str, ...]


def as_literal_path(path: str) -> str:
    """Keep characters of a file name from being taken for a wildcard."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_text(spark: SparkSession, path: str, text: str, encoding: str = UTF8) -> None:
    """A small file of facts about the data, such as a marker or a lone header line."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(text.encode(encoding)))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode(UTF8)
    finally:
        stream.close()


def export_of(path: Column) -> Column:
    """The export a file belongs to: itself, or the folder of that name it is a part of."""
    return F.regexp_replace(path, r"(?i)(\.csv)/[^/]*$", "$1")


def csv_folders(spark: SparkSession, folder: str) -> list[str]:
    """Folders directly in a folder that stand for one delimited file in parts."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    found = [s.getPath().toString() for s in fs.listStatus(target) if s.isDirectory()]
    return [p for p in found if p.lower().endswith(".csv")]


def list_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Path, URI, modification time and size of exports; contents are not read.

    A folder named like a file counts as one file that was written in parts.
    """
    there = [as_literal_path(p) for p in paths if path_exists(spark, p)]
    if not there:
        return spark.createDataFrame([], "path string, uri string, modified timestamp, length long")
    return (
        spark.read.format("binaryFile")
        .load(there)
        .select(
            export_of(F.col("path")).alias("path"),
            export_of(F.col("_metadata.file_path")).alias("uri"),
            "modificationTime",
            "length",
        )
        .groupBy("path", "uri")
        .agg(F.max("modificationTime").alias("modified"), F.sum("length").alias("length"))
    )


def choose_inputs(listing: DataFrame, options: DeliveryOptions) -> DataFrame:
    """The export of every region and month: newest file with the month in its name.

    Without ``strict_input`` a file that carries no month stands in where there is none.
    The result has one row per region and month that has a file. A file lies in the folder
    of its region; letter case in its name does not matter.
    """
    parts = F.split("path", "/")
    folder, name = F.element_at(parts, -2), F.element_at(parts, -1)
    months = "|".join(re.escape(s) for s in options.suffixes)
    in_own_folder = listing.where(folder.isin(*options.regions))

    def by_region(template: str) -> Column:
        """The month a name carries, "" for a name that fits without one, NULL for others."""
        found = F.lit(None)
        for region in options.regions:
            pattern = template.format(region=re.escape(region), suffix=f"({months})")
            fits = name.rlike(f"(?iu)^{pattern}$")
            # The second branch never matters; it gives patterns without a month a first group.
            month = F.regexp_extract(name, f"(?iu)^{pattern}$|^$()", 1)
            found = F.when((folder == region) & fits, month).otherwise(found)
        return found

    fits = in_own_folder.select(
        "*",
        folder.alias("region"),
        F.lower(by_region(options.export_name)).alias("month"),
        F.lit(1).alias("priority"),
    )
    if not options.strict_input:
        fits = fits.unionByName(
            in_own_folder.where(by_region(options.export_name_without_month).isNotNull()).select(
                "*",
                folder.alias("region"),
                F.explode(F.array(*[F.lit(s) for s in options.suffixes])).alias("month"),
                F.lit(0).alias("priority"),
            )
        )
    newest = F.max(F.struct("priority", "modified", "path", "uri", "length")).alias("best")
    return (
        fits.where("month IS NOT NULL")
        .groupBy("region", F.col("month").alias("suffix"))
        .agg(newest)
        .select("region", "suffix", "best.path", "best.uri", "best.modified", "best.length")
    )


def missing_inputs(chosen: Iterable, options: DeliveryOptions) -> list[tuple[str, str]]:
    """Regions and months that no file was found for."""
    found = {(r["region"], r["suffix"]) for r in chosen}
    return [(g, s) for s in options.suffixes for g in options.regions if (g, s) not in found]


def split_line(line: str, delimiter: str) -> tuple[str, ...]:
    rows = list(csv.reader([line], delimiter=delimiter, quotechar='"', doublequote=True))
    return tuple(rows[0]) if rows else ()


def detect_delimiter(header: Column, tie_delimiter: str = ";") -> Column:
    """The separator that cuts the header into more fields."""

    def fields(delimiter: str) -> Column:
        last_is_empty = (header == "") | header.endswith(delimiter)
        return F.size(F.split(header, delimiter, -1)) - last_is_empty.cast("int")

    semicolons, commas = fields(";"), fields(",")
    return F.when(semicolons == commas, tie_delimiter).when(semicolons > commas, ";").otherwise(",")


# What can be said of a line, one bit each.
NOT_UTF8, MARKS_AS_UTF8, MARKS_AS_BYTES, ODD_QUOTES = 1, 2, 4, 8


def profile(spark: SparkSession, paths: Iterable[str], options: DeliveryOptions) -> DataFrame:
    """Delimiter, encoding, header and other facts of exports, from one pass over their lines.

    One row per export and header; the parts of an export that begin alike are in one row, parts without
    a line in none. ``has_marks`` tells whether any line shows the marks of a wrong decoding,
    ``broken_lines`` whether any holds an odd number of quotes, as the first line of a cell with a
    line feed does. Files without marks are read without the repair.

    Lines are only looked at, so what is shuffled is a row per part and task. The header is the first
    line that is not blank, by its place in the part.
    """
    lines = spark.read.text([as_literal_path(p) for p in paths], lineSep="\n").select(
        F.col("_metadata.file_path").alias("part"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
        F.col("value").alias("line"),
    )
    line, raw = F.col("line"), F.col("line").cast("binary")
    bytes_of_marks = [F.lit(mark.encode(LATIN1)) for mark in MOJIBAKE_MARKS]
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    bits = (
        F.when(F.is_valid_utf8(line), 0).otherwise(NOT_UTF8)
        + F.when(has_mojibake(line), MARKS_AS_UTF8).otherwise(0)
        + F.when(reduce(or_, [F.contains(raw, b) for b in bytes_of_marks]), MARKS_AS_BYTES).otherwise(0)
        + F.when(quotes % 2 == 1, ODD_QUOTES).otherwise(0)
    )
    filled = F.btrim(line, F.lit(CONTROLS)) != ""
    # The set of bits makes this a hash aggregate of objects; without it lines would be sorted first.
    per_part = lines.groupBy("part").agg(
        F.collect_set(bits).alias("seen"), F.min_by(F.when(filled, raw), F.when(filled, F.col("place"))).alias("head")
    )

    def any_line(bit: int) -> Column:
        return F.exists("seen", lambda x: x.bitwiseAND(bit) != 0)

    # A row per part goes through this window, no line does.
    export = Window.partitionBy("uri")
    whole = per_part.withColumn("uri", export_of(F.col("part"))).select(
        "uri",
        "part",
        "head",
        *[
            F.bool_or(any_line(bit)).over(export).alias(name)
            for name, bit in (("bad", NOT_UTF8), ("utf8", MARKS_AS_UTF8), ("bytes", MARKS_AS_BYTES), ("broken_lines", ODD_QUOTES))
        ],
    )
    if options.encoding_override:
        forced = normal_encoding(options.encoding_override)
        encoding, has_marks = F.lit(forced), F.lit(True)
        decoded = F.decode("head", LATIN1 if forced in (UTF8, CP1252) else forced)
    else:
        encoding = F.when(F.col("bad"), CP1252).otherwise(UTF8)
        has_marks = F.when(F.col("bad"), F.col("bytes")).otherwise(F.col("utf8"))
        decoded = F.decode("head", LATIN1)
    text = (
        F.when(encoding == UTF8, F.make_valid_utf8(F.col("head").cast("string")))
        .when(encoding == CP1252, decode_cp1252(decoded))
        .otherwise(decoded)
    )
    head = nbsp_to_space(F.regexp_replace(F.regexp_replace(text, "^\ufeff", ""), "\r+$", ""))
    delimiter = detect_delimiter(F.col("head"), options.tie_delimiter)
    unquoted = F.regexp_replace("head", '"[^"]*"', "")
    return (
        whole.where("head IS NOT NULL")
        .select("uri", "part", encoding.alias("encoding"), has_marks.alias("has_marks"), "broken_lines", head.alias("head"))
        .groupBy("uri", "encoding", "has_marks", "broken_lines", "head")
        .agg(F.sort_array(F.collect_list("part")).alias("parts"))
        .withColumn("delimiter", delimiter)
        .withColumn("n_columns", F.size(F.split(unquoted, F.col("delimiter"), -1)))
    )


def normal_encoding(name: str) -> str:
    known = {
        "utf8": UTF8, "cp1252": CP1252, "windows1252": CP1252,
        "latin1": LATIN1, "iso88591": LATIN1,
    }
    return known.get(re.sub("[^a-z0-9]", "", name.lower()), name)


def profile_files(spark: SparkSession, chosen: list, options: DeliveryOptions) -> list[ExportFile]:
    """The facts of every chosen export, from one job.

    An export in parts gives one entry for all parts that begin alike, so each part is read by its
    own header. Parts without a line are left out where others have one.
    """
    targets: dict[str, list[tuple[str, str]]] = {}
    rows = {}
    for r in sorted(chosen, key=lambda r: (r["suffix"], r["region"])):
        targets.setdefault(r["path"], []).append((r["region"], r["suffix"]))
        rows[r["path"]] = r
    if not rows:
        return []
    found: dict[str, list] = {}
    for fact in profile(spark, rows, options).collect():
        found.setdefault(fact["uri"], []).append(fact)

    files = []
    for path, r in rows.items():
        place = dict(path=path, uri=r["uri"], modified=r["modified"], length=r["length"], targets=tuple(targets[path]))
        facts = sorted(found.get(r["uri"], []), key=lambda f: f["parts"][0])
        for f in facts:
            header = tuple(clean_header_text(h) for h in split_line(f["head"], f["delimiter"]))
            files.append(
                ExportFile(
                    **place, delimiter=f["delimiter"], encoding=f["encoding"], has_marks=f["has_marks"],
                    broken_lines=f["broken_lines"], header=header, parts=tuple(unquote(p) for p in f["parts"]),
                )
            )
        if not facts:  # no line at all
            empty = dict(delimiter=options.tie_delimiter, encoding=UTF8, has_marks=False, broken_lines=False)
            files.append(ExportFile(**place, **empty, header=(), parts=(path,)))
    return files
