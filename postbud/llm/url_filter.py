"""Judge URLs by pattern rules, in DataFrame functions only.

A rule is ``host`` or ``host/path``: it fits its host and every subdomain of it, if the URL's path
starts with the rule's; ``*`` stands for any characters, and a rule without host fits every host. The
longest rule that fits gives the verdict (of equal length the one that sorts last; of one rule listed
with two verdicts ``block``); where none fits the verdict is ``DEFAULT``.

No rule is tried on every URL. A token is a whole run of ASCII letters and digits. Every rule is
filed under the one of its literal tokens that the fewest URLs hold, counted over all of them; tokens
that touch a ``*`` or the open end of the path are no whole runs and do not count. A URL's tokens fetch the rules
filed under them, and only those run as regular expressions. Rules without a token are filed under
the empty one, which every URL holds.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased;
the path is what follows up to ``?``, ``#`` or the end. A null URL or one without ``://`` has neither. Rows
are told apart by themselves, not by ``page_id``, so null and repeated ids give a row each; only
``page_id`` and ``url`` are read, so other columns cannot clash. An empty table gives an empty one.

Tokens are counted with partial sums. Whether the rules are broadcast is left to Catalyst, which
goes by their size; beyond it both sides are plain shuffles, where AQE splits a frequent token.
"""

from __future__ import annotations

from collections.abc import Iterable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postbud.session import stage

#: Fixed values of the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DEFAULT = "allow"

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
TOKEN = "[0-9A-Za-z]+"
LITERAL_TOKEN = r"(?<![*0-9A-Za-z])[0-9A-Za-z]+(?=[^*0-9A-Za-z])"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]] = RULES) -> DataFrame:
    """Columns ``verdict`` and ``rule`` of (verdict, rule) pairs; a long list is better read from a table."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("rule")) for v, r in rules]
    listed = F.array(*rows) if rows else F.from_json(F.lit("[]"), "array<struct<verdict:string,rule:string>>")
    return spark.range(1).select(F.inline(listed))


def compiled(rules: DataFrame) -> DataFrame:
    """``rule``, ``verdict``, its regular expression over host and path, and its literal tokens."""
    host = lower_ascii(F.regexp_extract("rule", "(?s)^([^/]*)(.*)$", 1))
    path = F.regexp_extract("rule", "(?s)^([^/]*)(.*)$", 2)

    def pattern(c: Column) -> Column:
        return F.replace(F.regexp_replace(c, r"([\\^$.|?+()\[\]{}])", r"\\$1"), F.lit("*"), F.lit(".*"))

    of_host = F.when(host == "", F.lit("[^/]*")).otherwise(F.concat(F.lit(r"(?:[^/]*\.)?"), pattern(host)))
    # The end of a host is a boundary also where the rule has no path.
    bounded = F.concat(host, F.when(path == "", F.lit("/")).otherwise(path))
    return rules.where("rule IS NOT NULL").select(
        "rule",
        "verdict",
        F.concat(F.lit("(?s)^"), of_host, F.lit(r"(?=/|\z)"), pattern(path)).alias("pattern"),
        F.array_distinct(F.regexp_extract_all(bounded, F.lit(LITERAL_TOKEN), F.lit(0))).alias("tokens"),
    )


def rarest_token_index(seen: DataFrame, rules: DataFrame) -> DataFrame:
    """Every rule with the one ``token`` it is filed under. ``seen``: a row per URL and token in it."""
    rules = compiled(rules)
    by_token = rules.select("rule", "verdict", "pattern", F.explode("tokens").alias("token"))
    found = seen.select("token").join(by_token.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"]
    filed = by_token.join(found, "token", "left").groupBy("rule", "verdict", "pattern").agg(rarest.alias("token"))
    return filed.unionByName(rules.where(F.size("tokens") == 0).select("rule", "verdict", "pattern", F.lit("").alias("token")))


def judge(pages: DataFrame, rules: DataFrame | None = None, default: str = DEFAULT) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``: a row per row."""
    url = F.col("url").cast("string")
    rows = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = stage(rows, "urls")
    whole = F.concat("host", "path")
    tokens = F.array_append(F.array_distinct(F.regexp_extract_all(whole, F.lit(TOKEN), F.lit(0))), F.lit(""))
    seen = rows.select("row", whole.alias("whole"), F.explode(tokens).alias("token"))
    index = stage(rarest_token_index(seen, rule_table(pages.sparkSession) if rules is None else rules), "rules")
    fitting = seen.join(index, "token").where(F.rlike("whole", F.col("pattern")))
    longest = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict"))
    best = fitting.groupBy("row").agg(longest.alias("best"))
    return rows.join(best, "row", "left").select(
        F.col("page_id").cast("long"), "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


ORACLE = f"""
WITH rules(verdict, rule) AS (VALUES {", ".join(f"('{v}', '{r}')" for v, r in RULES)}),
pages_ AS (
  SELECT row_number() OVER () AS row, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{ascii_uppercase}', '{ascii_lowercase}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), fits AS (
  SELECT row, rule, verdict, row_number() OVER (PARTITION BY row ORDER BY length(rule) DESC, rule DESC, verdict DESC) AS place
  FROM pages_ JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/')))
)
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict
FROM pages_ LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (row)
"""
