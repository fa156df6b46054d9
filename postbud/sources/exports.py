"""Reading exports: one scan per kind of file, cells cleaned, columns conformed."""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postbud.functions.predicates import KEY, NULL_TOKEN
from postbud.functions.text import decode_cp1252, repair_mojibake, strip_cr, trim_blanks
from postbud.operators.conform import (
    add_location_columns,
    column_fill,
    missing_columns,
    plan_header,
    require_key,
    union_regions,
)
from postbud.operators.keys import GATE_SCHEMA
from postbud.operators.quality import mojibake_by_group
from postbud.options import DeliveryOptions
from postbud.session import stage
from postbud.sources.files import (
    CONTROLS,
    CP1252,
    LATIN1,
    UTF8,
    ExportFile,
    as_literal_path,
    choose_inputs,
    csv_folders,
    export_of,
    list_files,
    missing_inputs,
    path_exists,
    profile_files,
    read_text,
    write_text,
)
from postbud.sources.quoted import whole_records

log = logging.getLogger("postbud")

CACHE_VERSION = "3"
MARKER = "_COLUMNS"
PLACE = ("region", "suffix", "key")
POSITION = ["_uri", "_part", "_block", "_i"]


class MissingInput(FileNotFoundError):
    pass


class MojibakeFound(ValueError):
    pass


@dataclass(frozen=True)
class Reports:
    """All conformed rows of a run, which columns each export brought, and which are absent."""

    rows: DataFrame
    present: dict[tuple[str, str], tuple[str, ...]]
    absent: tuple[tuple[str, str], ...] = ()
    # Failed checks of the files that did not stop the reading, in the schema of all gates.
    gates: tuple[Row, ...] = ()


GATE = Row(*(field.split()[0] for field in GATE_SCHEMA.split(", ")))


def find_exports(spark: SparkSession, options: DeliveryOptions) -> tuple[list[ExportFile], list[tuple[str, str]]]:
    """Chosen and profiled files, and the regions and months without one."""
    folders = [f"{options.base_dir}/{region}" for region in options.regions]
    in_parts = [p for folder in folders for p in csv_folders(spark, folder)]
    chosen = choose_inputs(list_files(spark, folders + in_parts), options).collect()
    absent = missing_inputs(chosen, options)
    if options.strict_input and "missing_input" not in options.warn_only:
        # A region without a folder is skipped; a folder without the month's file is an error.
        lost = [(g, s) for g, s in absent if path_exists(spark, f"{options.base_dir}/{g}")]
        if lost:
            raise MissingInput(f"no export for {', '.join(f'{g} {s}' for g, s in lost)}")
    return profile_files(spark, chosen, options), absent


def _cleaned(cells: Sequence[str], kind: ExportFile, options: DeliveryOptions) -> list[Column]:
    def clean(c: Column) -> Column:
        c = F.coalesce(strip_cr(c), F.lit(""))
        if kind.encoding == CP1252:
            c = decode_cp1252(c)
        return repair_mojibake(c) if options.repair_mojibake and kind.has_marks else c

    return [clean(F.col(c)).alias(c) for c in cells]


def _scan(spark: SparkSession, files: Sequence[ExportFile], options: DeliveryOptions) -> DataFrame:
    """Files of one kind in one scan: text cells by position, and where each row stands.

    Cells are split at line feeds only, so a carriage return inside a cell does not end the
    row. A cell of a column that the export has is never NULL. Column names are positions, as headers
    may repeat a name. Files with line feeds inside quoted cells go line by line through ``quoted``.
    """
    kind = files[0]
    cells = [f"c{i}" for i in range(len(kind.header))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cells])
    parsing = dict(
        sep=kind.delimiter, quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    )
    paths = [as_literal_path(p) for f in files for p in f.parts]
    uri = F.col("_metadata.file_path")
    place = [
        export_of(uri).alias("_uri"), uri.alias("_part"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_i"),
    ]
    quoted = options.multi_line or kind.broken_lines
    if quoted and kind.encoding in (UTF8, CP1252, LATIN1):
        line = F.col("value")
        line = F.make_valid_utf8(line) if kind.encoding == UTF8 else F.decode(line.cast("binary"), LATIN1)
        lines = stage(spark.read.text(paths, lineSep="\n").select(*place, line.alias("line")), "lines")
        filled = F.btrim("line", F.lit(CONTROLS)) != ""
        heads = lines.where((F.col("_block") == 0) & filled).groupBy("_part").agg(F.min("_i").alias("_head"))
        # One row per file of these exports, joined by its measured size.
        body = lines.join(heads, "_part", "left").where((F.col("_block") > 0) | (F.col("_i") > F.col("_head"))).drop("_head")
        records = whole_records(body, kind.delimiter).where(filled)
        parsed = F.from_csv("line", schema.simpleString()[7:-1].replace(":", " "), {**parsing, "lineSep": "\n"})
        return records.select(parsed.alias("r"), *POSITION).select(*POSITION, "r.*").select(*_cleaned(cells, kind, options), *POSITION)
    reader = spark.read.schema(schema).options(
        header=True, enforceSchema=True, encoding=LATIN1 if kind.encoding == CP1252 else kind.encoding,
        multiLine=quoted, **parsing,
    )
    if not quoted:
        reader = reader.option("lineSep", "\n")
    return reader.csv(paths).select(*_cleaned(cells, kind, options), *place)


def _kinds(files: Sequence[ExportFile]) -> list[list[ExportFile]]:
    """Files that can share a scan: what their first lines and bytes say is the same."""
    groups: dict[tuple, list[ExportFile]] = {}
    for f in files:
        kind = (f.header, f.delimiter, f.encoding, f.has_marks, f.broken_lines)
        groups.setdefault(kind, []).append(f)
    return list(groups.values())


def _parsed(spark: SparkSession, kinds: Sequence[Sequence[ExportFile]], options: DeliveryOptions) -> DataFrame:
    """All cells of all files, parsed once into a columnar table that everything else reads.

    Its columns are positions, so files with other headers share it; ``_kind`` says which header holds,
    ``_raw_key`` is the cell below a header that is exactly the key's name.
    """
    scans = []
    for k, files in enumerate(kinds):
        scan, header = _scan(spark, files, options), files[0].header
        raw_key = F.col(f"c{header.index(KEY)}") if KEY in header else F.lit(None).cast("string")
        scans.append(scan.withColumns({"_kind": F.lit(k), "_raw_key": raw_key}))
    return stage(union_regions(scans), "cells")


def _repeated_headers(cells: DataFrame) -> DataFrame | None:
    """Where the first data row of an export repeats its header, at most one place per export.

    The first row is the first one of the first part that has any, by its place in the file. It repeats the
    header if its key cell says so; rows like it further down are data.
    """
    # A row per part: numbers only are aggregated, and only over the first block of each part.
    tops = cells.where("_block = 0").groupBy("_uri", "_part").agg(F.min("_i").alias("_i"))
    first = tops.groupBy("_uri").agg(F.min(F.struct("_part", "_i")).alias("first")).select("first.*")
    # A row per export, so this side always fits.
    found = cells.where("_block = 0").join(F.broadcast(first), ["_part", "_i"]).where(F.col("_raw_key").isin(KEY, NULL_TOKEN))
    rows = [tuple(r) for r in found.select("_part", "_i").collect()]
    return cells.sparkSession.createDataFrame(rows, "_part string, _i long") if rows else None


def _without_repeated_headers(cells: DataFrame, places: DataFrame | None) -> DataFrame:
    if places is None:
        return cells
    at = F.broadcast(places.withColumn("_block", F.lit(0).cast("long")))
    return cells.join(at, POSITION[1:], "left_anti")


def _kept_columns(
    cells: DataFrame, places: DataFrame | None, group: list[ExportFile], options: DeliveryOptions
) -> dict[str, tuple[int, ...]]:
    """Positions each file keeps after the empty-column rules."""
    width = len(group[0].header)
    everything = tuple(range(width))
    kept = {f.uri: everything for f in group}
    at = options.drop_position - 1 if options.drop_position else width
    if at < width:
        # Looked at before a repeated header row is left out.
        filled = _filled_by_file(cells, [at])
        kept = {u: tuple(i for i in p if i != at or _has_values(filled, u, i)) for u, p in kept.items()}
    if options.drop_empty_columns:
        filled = _filled_by_file(_without_repeated_headers(cells, places), everything)
        kept = {u: tuple(i for i in p if _has_values(filled, u, i)) for u, p in kept.items()}
    return kept


def _filled_by_file(cells: DataFrame, positions: Sequence[int]) -> dict[str, Row]:
    """Which columns hold anything, per file; one row per file comes back."""
    columns = [f"c{i}" for i in positions]
    return {r["_uri"]: r for r in column_fill(cells.select("_uri", *columns), by=["_uri"]).collect()}


def _has_values(filled: dict[str, Row], uri: str, position: int) -> bool:
    """A file without rows keeps all its columns."""
    return uri not in filled or filled[uri][f"c{position}"]


@dataclass(frozen=True)
class _Piece:
    """Conformed rows of the files that share a scan and keep the same columns."""

    files: tuple[ExportFile, ...]
    columns: tuple[str, ...]
    rows: DataFrame


def _with_key(files: Sequence[ExportFile], options: DeliveryOptions) -> tuple[list[list[ExportFile]], list[Row]]:
    """Kinds of files whose header has the key column, and a failed check for each of the others."""
    kept, gates = [], []
    for group in _kinds(files):
        names = plan_header(group[0].header, options.header_aliases, options.alias_policy).names
        if "missing_key" not in options.warn_only:
            require_key(names, ", ".join(f.path for f in group))
        if KEY in names:
            kept.append(group)
        else:
            gates += [GATE("missing_key", s, g, len(f.parts), f.path) for f in group for g, s in f.targets]
    return kept, gates


def _pieces(
    spark: SparkSession, files: Sequence[ExportFile], options: DeliveryOptions
) -> tuple[list[_Piece], list[Row]]:
    """Conformed rows by kind of file, and the checks of columns that failed."""
    pieces = []
    kinds, gates = _with_key(files, options)
    if not kinds:
        return [], gates
    every_cell = _parsed(spark, kinds, options)
    places = _repeated_headers(every_cell)
    for k, group in enumerate(kinds):
        by_columns: dict[tuple[int, ...], list[ExportFile]] = {}
        cells = every_cell.where(F.col("_kind") == k)
        kept = _kept_columns(cells, places, group, options)
        at = (options.drop_position or 0) - 1
        gates += [
            GATE("column_kept", s, g, 1, group[0].header[at])
            for f in group for g, s in f.targets if 0 <= at < len(group[0].header) and at in kept[f.uri]
        ]
        for f in group:
            by_columns.setdefault(kept[f.uri], []).append(f)
        for positions, alike in by_columns.items():
            plan = plan_header(
                [alike[0].header[i] for i in positions], options.header_aliases, options.alias_policy
            )
            require_key(plan.names, ", ".join(f.path for f in alike))
            # One row per region and month, so this side always fits.
            rows = _without_repeated_headers(cells, places)
            placed = rows.join(F.broadcast(_targets(spark, alike, options)), "_uri")
            named = placed.select(
                *PLACE, *[F.col(f"c{i}").alias(n) for i, n in zip(positions, plan.names)]
            )
            if options.trim_ids:
                named = named.withColumn(KEY, trim_blanks(F.col(KEY)))
            rows = add_location_columns(named, options.absent_location_token)
            pieces.append(_Piece(tuple(alike), plan.names, rows))
            for old, target in plan.collisions:
                log.warning("column %s is not taken as %s, which another is", old, target)
    return pieces, gates


def _targets(spark: SparkSession, files: Sequence[ExportFile], options: DeliveryOptions) -> DataFrame:
    rows = [(f.uri, g, s, _cache_key(f, options)) for f in files for g, s in f.targets]
    return spark.createDataFrame(rows, "_uri string, region string, suffix string, key string")


def read_files(spark: SparkSession, files: Sequence[ExportFile], options: DeliveryOptions) -> Reports | None:
    """Conformed rows of profiled files with their ``region`` and ``suffix``."""
    pieces, gates = _pieces(spark, files, options)
    if not pieces:
        return None
    rows = union_regions(p.rows.drop("key") for p in pieces)
    return Reports(rows, _columns_by_place(pieces), gates=tuple(gates))


def _columns_by_place(pieces: Sequence[_Piece]) -> dict[tuple[str, str], tuple[str, ...]]:
    """Columns of every region and month, over all parts of its export."""
    present: dict[tuple[str, str], dict[str, None]] = {}
    for piece in pieces:
        for target in (t for f in piece.files for t in f.targets):
            present.setdefault(target, {}).update(dict.fromkeys(piece.columns))
    return {target: tuple(columns) for target, columns in present.items()}


def load_reports(spark: SparkSession, options: DeliveryOptions) -> Reports | None:
    """Every region and month of a run as one table, through the cache if there is one."""
    files, absent = find_exports(spark, options)
    if not files:
        return None
    read = read_files if options.cache_dir is None else _read_through_cache
    reports = read(spark, files, options)
    if reports is None:
        return None
    gates = [GATE("missing_input", s, g, 1, None) for g, s in absent]
    if options.fail_on_mojibake:
        marks = mojibake_by_group(reports.rows).collect()  # a row per region and month at most
        found = [GATE("mojibake_in", r["suffix"], r["region"], r["n_mojibake"], None) for r in marks]
        if found and "mojibake_in" not in options.warn_only:
            raise MojibakeFound(f"{sum(g['failures'] for g in found)} cells look wrongly decoded after reading")
        gates += found
    return replace(reports, absent=tuple(absent), gates=(*reports.gates, *gates))


# --- cleaned tables kept as parquet ---------------------------------------------------------


def _reading(options: DeliveryOptions) -> str:
    """Names a way of reading; entries of another way stand beside each other."""
    how = (
        CACHE_VERSION, options.encoding_override, options.tie_delimiter, options.repair_mojibake,
        options.multi_line, options.drop_empty_columns, options.drop_position,
        options.alias_policy, sorted(options.header_aliases.items()),
        options.absent_location_token, options.trim_ids,
    )
    return hashlib.sha256(repr(how).encode()).hexdigest()[:12]


def _cache_key(f: ExportFile, options: DeliveryOptions) -> str:
    """Names one state of one source file read in one way, so an entry never goes stale."""
    state = hashlib.sha256(repr((f.uri, str(f.modified), f.length)).encode()).hexdigest()[:24]
    return f"k{_reading(options)}_{state}"


def _entry(f: ExportFile, target: tuple[str, str], options: DeliveryOptions) -> str:
    region, suffix = target
    return f"{options.cache_dir}/suffix={suffix}/region={region}/key={_cache_key(f, options)}"


def _evict(spark: SparkSession, files: Sequence[ExportFile], options: DeliveryOptions) -> None:
    """Delete entries of the same region, month and way of reading that another state of the source has replaced.

    They hold person data, so they go as soon as the new entry stands. Folders are looked at, no data is.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    for f in files:
        for target in f.targets:
            own = path(_entry(f, target, options))
            fs = own.getFileSystem(spark._jsc.hadoopConfiguration())
            for status in fs.listStatus(own.getParent()):
                name = status.getPath().getName()
                if name != own.getName() and name.startswith(f"key=k{_reading(options)}_"):
                    fs.delete(status.getPath(), True)


def _read_through_cache(spark: SparkSession, files: Sequence[ExportFile], options: DeliveryOptions) -> Reports | None:
    """Read cleaned parquet; exports without an entry are parsed and written first.

    An entry counts once its marker stands, which is its manifest: the source and its state, the columns of the
    export, and the checks of its columns that failed. A run lost half way leaves no marker, and the next
    one replaces what it wrote.
    """

    def marker(f: ExportFile, target: tuple[str, str]) -> str:
        return f"{_entry(f, target, options)}/{MARKER}"

    kinds, gates = _with_key(files, options)
    files = [f for group in kinds for f in group]
    if not files:
        return None
    new = [f for f in files if not all(path_exists(spark, marker(f, t)) for t in f.targets)]
    if new:
        pieces, failed = _pieces(spark, new, options)
        (
            union_regions(p.rows for p in pieces)
            .write.partitionBy("suffix", "region", "key")
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(options.cache_dir)
        )
        columns_of = _columns_by_place(pieces)
        for (path, target), f in {(marker(f, t), t): f for f in new for t in f.targets}.items():
            manifest = {
                "source": f.uri, "modified": str(f.modified), "length": f.length, "columns": columns_of[target],
                "gates": [list(g) for g in failed if (g["region"], g["suffix"]) == target],
            }
            write_text(spark, path, json.dumps(manifest, ensure_ascii=False))
        _evict(spark, new, options)

    manifests = {t: json.loads(read_text(spark, marker(f, t))) for f in files for t in f.targets}
    present = {t: tuple(m["columns"]) for t, m in manifests.items()}
    gates += [GATE(*g) for m in manifests.values() for g in m["gates"]]
    columns = list(dict.fromkeys(c for names in present.values() for c in names))
    columns += missing_columns(columns, ("KommuneNr", "BydelNr"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, *PLACE]])
    entries = sorted({_entry(f, t, options) for f in files for t in f.targets})
    rows = (
        spark.read.schema(schema)
        .option("basePath", options.cache_dir)
        .parquet(*[as_literal_path(e) for e in entries])
    )
    return Reports(rows.select("region", "suffix", *columns), present, gates=tuple(gates))
