"""What each query must return, in DuckDB SQL over the given tables."""

from __future__ import annotations

from postbud.layout import DELIVERY_COLUMNS
from postbud.queries.standins import EXPORT_COLUMNS

MONTH_NAMES = "['jan','feb','mar','apr','mai','jun','jul','aug','sep','okt','nov','des']"

REPORT = f"""
report AS (
  SELECT o_orderkey AS rad,
    {MONTH_NAMES}[month(o_orderdate)] || '25' AS suffix,
    CASE WHEN n_regionkey IN (0, 3) THEN 'HSØ' WHEN n_regionkey IN (1, 4) THEN 'HV' ELSE 'HMN' END AS region,
    CASE WHEN o_orderkey % 101 = 0 THEN 'NULL' WHEN o_orderkey % 103 = 0 THEN ''
         WHEN o_orderkey % 107 = 0 THEN 'NPRId' WHEN o_orderkey % 109 = 0 THEN NULL
         ELSE CAST(o_custkey AS VARCHAR) END AS "NPRId",
    CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN 'NULL'
         ELSE lpad(CAST(o_custkey % 40 AS VARCHAR), 4, '0') END AS "KommuneNr",
    CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey % 9 AS VARCHAR)
         WHEN o_orderkey % 4 = 1 THEN '' ELSE NULL END AS "BydelNr",
    CASE WHEN o_totalprice < 10000 THEN 'ukjent' ELSE strftime(o_orderdate, '%d.%m.%Y') END AS "StartDato",
    CASE WHEN o_totalprice < 10000 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS start_day,
    CASE WHEN n_regionkey = 2 THEN '' WHEN o_orderpriority = '5-LOW' THEN NULL
         ELSE CAST(year(o_orderdate) AS VARCHAR) END AS "År",
    CASE o_orderpriority WHEN '1-URGENT' THEN ' ' || n_nationkey || ' ' WHEN '2-HIGH' THEN n_nationkey || '.7'
         WHEN '3-MEDIUM' THEN CAST(n_nationkey AS VARCHAR) WHEN '4-NOT SPECIFIED' THEN 'ukjent'
         ELSE '' END AS "institusjonId",
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN n_nationkey END AS institution_number,
    n_name AS "institusjon", c_mktsegment AS "Fagenhet",
    lower(c_mktsegment) || ' løp; ' || o_orderstatus AS "Pakkeforløp",
    'P' || o_orderkey AS "pfInstansId", o_orderstatus AS "OF1",
    CAST(NULL AS VARCHAR) AS "OF4", '' AS "Overf"
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), valid AS (
  SELECT * FROM report WHERE "NPRId" IS NOT NULL AND "NPRId" NOT IN ('', 'NPRId', 'NULL')
)"""

EXPORTED = """
in_order AS (
  SELECT *, row_number() OVER (PARTITION BY region, suffix ORDER BY "pfInstansId") AS place FROM report
), exported AS (
  SELECT * FROM in_order
  WHERE (place = 1 AND region <> 'HV' AND "NPRId" IN ('NPRId', 'NULL')) IS NOT TRUE
)"""

# Rows with an even number come in the first part; all parts head their keys alike.
UNEQUAL = """
in_order AS (
  SELECT *, row_number() OVER (PARTITION BY region, suffix ORDER BY rad % 2, "pfInstansId") AS place FROM report
), exported AS (
  SELECT * FROM in_order WHERE (place = 1 AND "NPRId" IN ('NPRId', 'NULL')) IS NOT TRUE
)"""

NUMBERS = f"""
id_map AS (
  SELECT DISTINCT {MONTH_NAMES}[month(o_orderdate)] || '25' AS suffix, CAST(o_custkey AS VARCHAR) AS "NPRId",
    CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 300 THEN 'NULL'
         ELSE CAST(c_custkey * 7 + 1000 AS VARCHAR) END AS lopenr
  FROM orders JOIN customer ON o_custkey = c_custkey
), repeated AS (
  SELECT * FROM id_map UNION ALL
  SELECT * FROM id_map WHERE "NPRId" IN
    (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')
)"""

LOCATIONS = """
history AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS "NPRId", CAST(year(o_orderdate) AS INTEGER) AS aar,
    CASE WHEN o_orderstatus = 'F' THEN
      lpad(CAST((o_custkey + CASE WHEN o_custkey % 3 = 0 THEN year(o_orderdate) ELSE 0 END) % 40 AS VARCHAR), 4, '0')
    END AS komnrhjem2,
    CAST(o_custkey % 9 + 1 AS VARCHAR) AS bydel2
  FROM orders
), latest AS (
  SELECT "NPRId", komnrhjem2, bydel2, aar FROM (
    SELECT *, row_number() OVER (PARTITION BY "NPRId"
      ORDER BY aar DESC NULLS LAST, komnrhjem2 NULLS FIRST, bydel2 NULLS FIRST) AS rn FROM history)
  WHERE rn = 1
), overridden AS (
  SELECT l."NPRId", CASE WHEN c.c_custkey IS NOT NULL THEN '9999' ELSE l.komnrhjem2 END AS komnrhjem2, l.bydel2, l.aar
  FROM latest l LEFT JOIN customer c
    ON l."NPRId" = CAST(c.c_custkey AS VARCHAR) AND l.aar = 2000 AND c.c_mktsegment = 'MACHINERY'
), needed AS (
  SELECT DISTINCT suffix, "NPRId" FROM valid WHERE "KommuneNr" IS NULL OR "KommuneNr" IN ('', 'NULL')
), fixes AS (
  SELECT n.suffix, l.* FROM needed n JOIN overridden l USING ("NPRId")
)"""


def _missing(c: str) -> str:
    return f"({c} IS NULL OR {c} IN ('', 'NULL'))"


def _located() -> str:
    """Report rows with both fills, each from the values as they came in."""
    return f"""
located AS (
  SELECT r.* EXCLUDE ("KommuneNr", "BydelNr"), r."KommuneNr" AS kommune_in, r."BydelNr" AS bydel_in,
    CASE WHEN {_missing('r."KommuneNr"')} THEN f.komnrhjem2 ELSE r."KommuneNr" END AS "KommuneNr",
    CASE WHEN NOT {_missing('r."KommuneNr"')} AND r."KommuneNr" = f.komnrhjem2 AND {_missing('r."BydelNr"')}
         THEN f.bydel2 ELSE r."BydelNr" END AS "BydelNr",
    CASE WHEN (CASE WHEN {_missing('r."KommuneNr"')} THEN f.komnrhjem2 ELSE r."KommuneNr" END) = f.komnrhjem2
              AND r."BydelNr" IS NULL THEN f.bydel2 ELSE r."BydelNr" END AS bydel_filled
  FROM report r LEFT JOIN fixes f ON r.suffix = f.suffix AND r."NPRId" = f."NPRId"
)"""


DELIVERED = f"""
numbered AS (
  SELECT l.*, m.lopenr FROM located l JOIN id_map m ON l.suffix = m.suffix AND l."NPRId" = m."NPRId"
  WHERE m.lopenr <> 'NULL' AND l."NPRId" NOT IN ('', 'NPRId', 'NULL')
), with_year AS (
  SELECT * EXCLUDE ("År"), CASE
    WHEN max(CASE WHEN {_missing('"År"')} THEN 0 ELSE 1 END) OVER (PARTITION BY suffix, region) = 0
    THEN coalesce(CAST(year(start_day) AS VARCHAR), "År") ELSE "År" END AS "År"
  FROM numbered
)"""

IN_REPORT = {c for c in EXPORT_COLUMNS if c != "NPRId"}


def _output(have: set[str], integers: dict[str, str] | None = None, token: str | None = "NULL") -> str:
    """The output layout as a select list."""
    blank = "NULL" if token is None else f"'{token}'"
    cells = []
    for c in DELIVERY_COLUMNS:
        if integers and c in integers:
            cells.append(f'CAST({integers[c]} AS INTEGER) AS "{c}"')
        elif c in have:
            cells.append(f'coalesce(nullif("{c}", \'\'), {blank}) AS "{c}"')
        else:
            cells.append(f'CAST({blank} AS VARCHAR) AS "{c}"')
    return ", ".join(cells)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (REPORT, NUMBERS, LOCATIONS, _located())
FULL = _with(*BASE, DELIVERED)
HAVE = IN_REPORT | {"lopenr"}

KEY_PROFILE = f"""
profile AS (
  SELECT suffix, region, "NPRId", false AS own_number, count(*) AS n_rows,
    CAST(sum(CASE WHEN {_missing('"KommuneNr"')} THEN 1 ELSE 0 END) AS BIGINT) AS n_no_kommune,
    CAST(sum(CASE WHEN {_missing('"År"')} THEN 0 ELSE 1 END) AS BIGINT) AS n_year,
    CAST(0 AS BIGINT) AS n_mojibake,
    CAST(sum(CASE WHEN "institusjonId" <> '' THEN 1 ELSE 0 END) AS BIGINT) AS "n_filled_institusjonId",
    CAST(sum(CASE WHEN "institusjonId" = 'ukjent' THEN 1 ELSE 0 END) AS BIGINT) AS "n_lost_institusjonId"
  FROM report GROUP BY ALL
)"""

COUNTS = f"""
counts AS (
  SELECT region, suffix, count(*) AS "rows",
    CAST(sum(CASE WHEN {_missing('"KommuneNr"')} THEN 1 ELSE 0 END) AS BIGINT) AS missing_kommune,
    CAST(0 AS BIGINT) AS mojibake,
    CAST(sum(CASE WHEN "institusjonId" = 'ukjent' THEN 1 ELSE 0 END) AS BIGINT) AS "n_lost_institusjonId",
    CAST(sum(CASE WHEN "institusjonId" <> '' THEN 1 ELSE 0 END) AS BIGINT) AS "n_filled_institusjonId"
  FROM with_year GROUP BY ALL
)"""

TEN_FIRST = """string_agg("NPRId", ', ' ORDER BY "NPRId") FILTER (WHERE place <= 10)"""
PLACED = """SELECT *, row_number() OVER (PARTITION BY suffix ORDER BY "NPRId") AS place FROM"""

# Letters of the documents that are not a letter with an accent.
PLAIN = """replace(replace(replace(replace(strip_accents(lower(text)), 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'), 'ø', 'o')"""


def _blank_as_null(columns) -> str:
    return ", ".join(f'nullif("{c}", \'\') AS "{c}"' for c in columns)


def _nulls(columns) -> str:
    return ", ".join("'P'" if c == "pfInstansId" else "NULL" for c in columns)


def _column_rows(value: str, pairs: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {expression} AS {value} FROM {source}" for c, expression in pairs.items()
    )


REPORT_COLUMNS = (
    "rad", "suffix", "region", "NPRId", "KommuneNr", "BydelNr", "StartDato", "År", "institusjonId",
    "institusjon", "Fagenhet", "Pakkeforløp", "pfInstansId", "OF1", "OF4", "Overf",
)


def _empty_columns() -> str:
    pairs = {
        c: f"""count(*) FILTER (WHERE "{c}" IS NOT NULL AND CAST("{c}" AS VARCHAR) <> '') = 0"""
        for c in REPORT_COLUMNS
    }
    return _with(REPORT) + _column_rows("is_empty", pairs, "report")


def _missing_layout_columns() -> str:
    parts = []
    for c in DELIVERY_COLUMNS:
        having = ""
        if c in IN_REPORT:
            having = f"""HAVING count(*) FILTER (WHERE "{c}" IS NOT NULL AND "{c}" <> '') = 0"""
        parts.append(f"SELECT region, suffix, '{c}' AS missing_column FROM report GROUP BY region, suffix {having}")
    return _with(REPORT) + " UNION ALL ".join(parts)


def _metric(name: str, value: str, source: str, region: bool = False) -> str:
    group = "suffix, region" if region else "suffix"
    shown = "region" if region else "CAST(NULL AS VARCHAR) AS region"
    return (
        f"SELECT suffix, {shown}, '{name}' AS metric, CAST({value} AS BIGINT) AS value FROM {source} GROUP BY {group}"
    )


def _run_metrics() -> str:
    parts = [
        _metric("input_rows", "count(*)", "report", True),
        _metric("total_rows", "count(*)", "report"),
        _metric("distinct_ids", """count(DISTINCT "NPRId") + max(CASE WHEN "NPRId" IS NULL THEN 1 ELSE 0 END)""", "report"),
        _metric("request_rows", """count(DISTINCT "NPRId")""", "valid"),
        _metric("return_rows", "count(*)", "id_map"),
        _metric("delivery_rows", 'max("rows")', "counts", True),
        _metric("missing_kommune", "max(missing_kommune)", "counts", True),
        _metric("lost_institusjonId", 'max("n_lost_institusjonId")', "counts", True),
        _metric("filled_institusjonId", 'max("n_filled_institusjonId")', "counts", True),
        _metric("missing_kommune_ids", "count(*)", "needed"),
        _metric("geo_rows", "count(*)", "fixes"),
    ]
    return _with(*BASE, DELIVERED, COUNTS) + " UNION ALL ".join(parts)


def _gates() -> str:
    none = "CAST(NULL AS VARCHAR)"
    return _with(*BASE, DELIVERED, COUNTS) + f"""
    , dup AS ({PLACED} (SELECT suffix, "NPRId" FROM repeated GROUP BY ALL HAVING count(*) > 1)),
    lost AS ({PLACED} (SELECT v.suffix, v."NPRId" FROM (SELECT DISTINCT suffix, "NPRId" FROM valid) v
      LEFT JOIN repeated m ON v.suffix = m.suffix AND v."NPRId" = m."NPRId" WHERE {_missing('m.lopenr')}))
    SELECT 'map_duplicates' AS gate, suffix, {none} AS region, count(*) AS failures, {TEN_FIRST} AS sample
      FROM dup GROUP BY suffix
    UNION ALL SELECT 'unmapped', suffix, {none}, count(*), {TEN_FIRST} FROM lost GROUP BY suffix
    UNION ALL SELECT 'cast_loss:institusjonId', suffix, region, "n_lost_institusjonId", {none} FROM counts
      WHERE "n_lost_institusjonId" > 0"""


def _gates_of_faulty_input() -> str:
    none = "CAST(NULL AS VARCHAR)"
    return _with(REPORT, NUMBERS) + f"""
    , known AS (SELECT * FROM id_map WHERE suffix <> 'des25'),
    lost AS ({PLACED} (SELECT v.suffix, v."NPRId" FROM (SELECT DISTINCT suffix, "NPRId" FROM valid) v
      LEFT JOIN known m ON v.suffix = m.suffix AND v."NPRId" = m."NPRId" WHERE {_missing('m.lopenr')}))
    SELECT 'map_empty' AS gate, 'des25' AS suffix, {none} AS region, count(*) AS failures, {none} AS sample
      FROM (SELECT DISTINCT suffix FROM report WHERE suffix = 'des25')
    UNION ALL SELECT 'unmapped', suffix, {none}, count(*), {TEN_FIRST} FROM lost GROUP BY suffix
    UNION ALL SELECT 'mojibake_out', v.suffix, v.region, count(*), {none} FROM valid v
      JOIN known m ON v.suffix = m.suffix AND v."NPRId" = m."NPRId" WHERE NOT {_missing('m.lopenr')} GROUP BY 2, 3"""


# A run that lacks the file of one region for December, and any location.
SHORT = f"""
there AS (SELECT * FROM report WHERE NOT (region = 'HMN' AND suffix = 'des25')),
sent AS (
  SELECT t.*, m.lopenr FROM there t JOIN id_map m ON t.suffix = m.suffix AND t."NPRId" = m."NPRId"
  WHERE m.lopenr <> 'NULL' AND t."NPRId" NOT IN ('', 'NPRId', 'NULL')
)"""


def _run_check_files() -> str:
    wanted = ", ".join(f"'{c}'" for c in DELIVERY_COLUMNS if c not in EXPORT_COLUMNS and c not in ("lopenr", "År"))
    return _with(REPORT, NUMBERS, SHORT) + f"""
    SELECT 'unmapped' AS kind, v.suffix, CAST(NULL AS VARCHAR) AS place, concat_ws(' ', v."NPRId", m.lopenr) AS what
      FROM (SELECT DISTINCT suffix, "NPRId" FROM there WHERE "NPRId" NOT IN ('', 'NPRId', 'NULL')) v
      LEFT JOIN id_map m ON v.suffix = m.suffix AND v."NPRId" = m."NPRId" WHERE {_missing('m.lopenr')}
    UNION ALL SELECT 'missing_columns', suffix, region, c
      FROM (SELECT DISTINCT suffix, region FROM there), (SELECT unnest([{wanted}]) AS c)
    UNION ALL SELECT 'summary', p.suffix, p.region, count(s.rad) || ' ' || count(s.rad) FILTER (WHERE {_missing('s."KommuneNr"')})
      FROM (SELECT DISTINCT suffix, region FROM there) p
      LEFT JOIN sent s ON s.suffix = p.suffix AND s.region = p.region GROUP BY p.suffix, p.region"""


def oracle_sql() -> dict[str, str]:
    # The first row of an export goes if it repeats the header; only HV heads its keys otherwise.
    exports = f'SELECT region, suffix, {_blank_as_null(EXPORT_COLUMNS)} FROM exported'
    deliveries = FULL + f"SELECT region, suffix, {_output(HAVE)} FROM with_year"
    return {
        # keys and numbers
        "request_ids": _with(REPORT) + """SELECT DISTINCT suffix, "NPRId", '' AS "Dummy" FROM valid""",
        "key_profile": _with(REPORT, KEY_PROFILE) + "SELECT * FROM profile",
        "id_profile": _with(REPORT) + """SELECT suffix, count(*) AS n_rows,
            count(DISTINCT "NPRId") + max(CASE WHEN "NPRId" IS NULL THEN 1 ELSE 0 END) AS n_distinct,
            count(DISTINCT "NPRId") FILTER (WHERE "NPRId" NOT IN ('', 'NPRId', 'NULL')) AS n_valid
            FROM report GROUP BY suffix""",
        "unmapped_ids": _with(REPORT, NUMBERS) + f"""SELECT DISTINCT v.suffix, v."NPRId", m.lopenr FROM valid v
            LEFT JOIN id_map m ON v.suffix = m.suffix AND v."NPRId" = m."NPRId" WHERE {_missing('m.lopenr')}""",
        "map_duplicates": _with(NUMBERS)
        + """SELECT suffix, "NPRId", count(*) AS n FROM repeated GROUP BY ALL HAVING count(*) > 1""",
        "duplicate_examples": _with(NUMBERS) + f"""SELECT suffix, {TEN_FIRST} AS sample FROM ({PLACED}
            (SELECT suffix, "NPRId" FROM repeated GROUP BY ALL HAVING count(*) > 1)) GROUP BY suffix""",
        "numbered_rows": _with(REPORT, NUMBERS) + """SELECT v.rad, v.region, v.suffix, v."NPRId", m.lopenr
            FROM valid v JOIN id_map m ON v.suffix = m.suffix AND v."NPRId" = m."NPRId" WHERE m.lopenr <> 'NULL'""",
        "deliverable_by_region": _with(REPORT, NUMBERS) + f"""SELECT v.region, count(*) AS n_rows,
            CAST(sum(CASE WHEN {_missing('v."KommuneNr"')} THEN 1 ELSE 0 END) AS BIGINT) AS missing_kommune
            FROM valid v JOIN id_map m ON v.suffix = m.suffix AND v."NPRId" = m."NPRId"
            WHERE m.lopenr <> 'NULL' GROUP BY v.region""",
        "return_cells": """SELECT c_name AS "NPRId",
            CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS lopenr FROM customer""",
        # location
        "ids_missing_municipality": _with(REPORT, LOCATIONS) + "SELECT * FROM needed",
        "geo_latest": _with(REPORT, LOCATIONS) + "SELECT * FROM latest",
        "geo_history_typed": _with(REPORT, LOCATIONS) + "SELECT * FROM history",
        "geo_overridden": _with(REPORT, LOCATIONS) + "SELECT * FROM overridden",
        "geo_fixes": _with(REPORT, LOCATIONS) + "SELECT * FROM fixes",
        "kommune_filled": _with(*BASE) + 'SELECT rad, "KommuneNr" FROM located',
        "bydel_original": _with(*BASE) + 'SELECT rad, "BydelNr" FROM located',
        "bydel_filled": _with(*BASE) + 'SELECT rad, bydel_filled AS "BydelNr" FROM located',
        # delivery
        "delivery_rows": FULL + f"SELECT rad, region, suffix, {_output(HAVE)} FROM with_year",
        "delivery_strict_types": FULL + "SELECT rad, region, suffix, "
        + _output(HAVE, {"lopenr": "lopenr", "institusjonId": "institution_number"}, None) + " FROM with_year",
        "delivery_without_fill": FULL + """SELECT rad, lopenr, coalesce(nullif(kommune_in, ''), 'NULL') AS "KommuneNr",
            coalesce(nullif(bydel_in, ''), 'NULL') AS "BydelNr" FROM with_year""",
        "year_backfill": FULL + """SELECT rad, coalesce(nullif("År", ''), 'NULL') AS "År" FROM with_year""",
        "number_rescue": _with(*BASE) + """SELECT l.rad,
            CASE WHEN m.lopenr <> 'NULL' THEN m.lopenr ELSE 'E' || l.rad END AS lopenr,
            coalesce(nullif(l."KommuneNr", ''), 'NULL') AS "KommuneNr"
            FROM located l LEFT JOIN id_map m ON l.suffix = m.suffix AND l."NPRId" = m."NPRId"
            WHERE l."NPRId" NOT IN ('', 'NPRId', 'NULL') AND (m.lopenr <> 'NULL' OR l."institusjonId" = 'ukjent')""",
        "output_shape": _with(REPORT) + f"SELECT rad, {_output(IN_REPORT)} FROM report",
        "delivery_table": FULL + """SELECT region, suffix, count(*) AS n_rows, count(DISTINCT lopenr) AS n_people
            FROM with_year GROUP BY ALL""",
        # quality
        "qc_summary": _with(*BASE, DELIVERED, COUNTS)
        + 'SELECT region AS "RHF", suffix, "rows", missing_kommune FROM counts',
        "delivery_counts": _with(*BASE, DELIVERED, COUNTS) + "SELECT * FROM counts",
        "month_control": FULL + """SELECT region, CAST(month(start_day) AS INTEGER) AS month, count(*) AS n_rows
            FROM with_year WHERE "År" = '1998' GROUP BY ALL""",
        "cast_loss": FULL + """SELECT region,
            count(*) FILTER (WHERE "institusjonId" <> '') AS "institusjonId_nonempty",
            count(*) FILTER (WHERE "institusjonId" = 'ukjent') AS "institusjonId_lost",
            count(*) AS lopenr_nonempty, CAST(0 AS BIGINT) AS lopenr_lost FROM with_year GROUP BY region""",
        "gates": _gates(),
        "gates_of_faulty_input": _gates_of_faulty_input(),
        "run_check_files": _run_check_files(),
        "input_gates": _with(REPORT, EXPORTED) + """SELECT 'missing_input' AS gate, 'des25' AS suffix, 'HMN' AS region,
              CAST(1 AS BIGINT) AS failures, CAST(NULL AS VARCHAR) AS sample
            UNION ALL SELECT DISTINCT 'column_kept', suffix, region, CAST(1 AS BIGINT),
              CASE region WHEN 'HV' THEN 'npr id' ELSE 'NPRId' END
              FROM report WHERE NOT (region = 'HMN' AND suffix = 'des25')
            UNION ALL SELECT 'mojibake_in', suffix, region, count(*), NULL
              FROM exported WHERE NOT (region = 'HMN' AND suffix = 'des25') GROUP BY suffix, region""",
        "run_metrics": _run_metrics(),
        "empty_columns": _empty_columns(),
        "missing_layout_columns": _missing_layout_columns(),
        # text, dates, numbers
        "mojibake_repair": "SELECT doc_id, text FROM documents",
        "mojibake_count": _column_rows(
            "n_mojibake",
            {
                c: f"count(*) FILTER (WHERE regexp_matches({c}, '[\\x{{0080}}-\\x{{00FF}}]'))"
                for c in ("text", "source", "lang")
            },
            "documents",
        ),
        "header_keys": f"SELECT doc_id, regexp_replace({PLAIN}, '[^a-z0-9]', '', 'g') AS header_key FROM documents",
        "parse_dates": """SELECT l_orderkey, l_linenumber,
            CASE WHEN l_linenumber <= 6 THEN CAST(l_shipdate AS DATE) END AS parsed FROM lineitem""",
        "month_suffix_counts": f"""SELECT {MONTH_NAMES}[month(l_shipdate)] || strftime(l_shipdate, '%y') AS suffix,
            count(*) AS n_rows FROM lineitem GROUP BY 1""",
        "integer_cast": """SELECT event_id, CASE
            WHEN event_type = 'error' THEN NULL
            WHEN event_type = 'click' THEN CAST(trunc(value) AS INTEGER)
            WHEN event_type = 'view' THEN TRY_CAST(CAST(trunc(value * 100000000) AS BIGINT) AS INTEGER)
            ELSE CAST(-trunc(value) AS INTEGER) END AS as_integer FROM events""",
        # shaping
        "union_regions": _with(REPORT) + """SELECT rad, "NPRId",
            CASE WHEN region IN ('HSØ', 'HMN') THEN "KommuneNr" END AS "KommuneNr",
            CASE WHEN region = 'HV' THEN "BydelNr" END AS "BydelNr",
            CASE WHEN region IN ('HV', 'HMN') THEN "institusjon" END AS "institusjon" FROM report""",
        "alias_conform": """SELECT CAST(c_custkey AS VARCHAR) AS "NPRId", c_name AS "institusjon",
            CAST(c_nationkey AS VARCHAR) AS "KommuneNr", CAST(c_acctbal AS VARCHAR) AS "FødselsDato",
            c_mktsegment AS "reshIdFagEnhet", c_mktsegment AS "Egen kolonne", 'NULL' AS "BydelNr" FROM customer""",
        # files
        "newest_inputs": _with(REPORT) + f"""SELECT * EXCLUDE (rn) FROM (
            SELECT region, suffix, path, length, row_number() OVER (PARTITION BY region, suffix
                ORDER BY priority DESC, modified DESC, path DESC) AS rn
            FROM (
              SELECT region, unnest(months) AS suffix, priority, modified, path, length FROM (
                SELECT r.region, o_orderdate AS modified, rad AS length,
                  '/in/' || region || '/Uttrekk ' || rad || ' rhf_' || region
                    || CASE WHEN o_orderstatus = 'O' THEN '' ELSE '_' || suffix END
                    || CASE WHEN o_orderpriority = '5-LOW' THEN '.CSV' ELSE '.csv' END AS path,
                  CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS priority,
                  CASE WHEN o_orderstatus = 'O' THEN list_transform({MONTH_NAMES}, lambda m: m || '25')
                    ELSE [suffix] END AS months
                FROM report r JOIN orders ON rad = o_orderkey))) WHERE rn = 1""",
        "file_profile": _with(REPORT) + f"""SELECT DISTINCT region, suffix,
            CASE WHEN region = 'HV' THEN ',' ELSE ';' END AS delimiter,
            CASE WHEN region = 'HMN' THEN 'Windows-1252' ELSE 'UTF-8' END AS encoding,
            CAST({len(EXPORT_COLUMNS)} AS INTEGER) AS n_columns FROM report""",
        "table_columns_dropped": _with(REPORT) + """SELECT * EXCLUDE ("OF4", "Overf", start_day, institution_number),
            false AS third_dropped FROM report""",
        "columns_dropped": _with(REPORT, EXPORTED) + " UNION ALL ".join(
            f"""SELECT {by} AS suffix, '{c}' AS missing_column FROM exported GROUP BY {by}
                HAVING count(*) FILTER (WHERE "{c}" <> '') = 0"""
            for by in ("suffix", "region") for c in EXPORT_COLUMNS
        ),
        "read_exports": _with(REPORT, EXPORTED) + exports,
        "cached_exports": _with(REPORT, EXPORTED) + exports,
        "repeated_header": _with(REPORT) + f"""SELECT region, suffix, {_blank_as_null(EXPORT_COLUMNS)} FROM report
            UNION ALL SELECT region, suffix, 'NPRId', {_nulls(EXPORT_COLUMNS[1:])}
            FROM (SELECT region, suffix, unnest(CASE WHEN region = 'HV' THEN [1, 2] ELSE [1] END)
              FROM report GROUP BY region, suffix)""",
        "read_returns": _with(NUMBERS) + "SELECT * FROM id_map",
        "csv_roundtrip": "SELECT doc_id, text FROM documents",
        "run_requests": _with(REPORT) + 'SELECT DISTINCT suffix, "NPRId" FROM valid',
        "run_deliveries": deliveries,
        "run_deliveries_in_parts": deliveries,
        "run_deliveries_one_file": deliveries,
        "parts_with_unequal_headers": _with(REPORT, UNEQUAL) + exports,
        "quoted_line_feeds": _with(REPORT, EXPORTED) + """SELECT region, suffix, "pfInstansId",
            replace("Pakkeforløp", '; ', '"' || chr(10) || ';') AS "Pakkeforløp" FROM exported""",
        # A delimited file does not tell NULL from the empty text; both are read as the latter.
        "bydel_filled_from_files": _with(REPORT, EXPORTED) + """SELECT "pfInstansId",
            coalesce("BydelNr", '') AS "BydelNr" FROM exported""",
    }
