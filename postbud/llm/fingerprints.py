"""Fingerprints of documents as Merkle trees, in DataFrame functions only.

A text is cut at line feeds into paragraphs, a paragraph at sentence ends and after ``PIECE_WORDS``
words into pieces, each with the white space before it, so that the pieces of a paragraph make it up. Pieces are the
leaves, hashed by MD5. Every other node hashes its children's hashes: a paragraph those of its pieces, a section
those of its paragraphs, the root (by SHA-256) those of the sections. So equal roots mean equal texts, and any branch can be
checked against the node above. A section is a run of paragraphs that ends at an empty one or where the
paragraph's hash says so (one in four), so that an edit moves no boundary elsewhere.

The fingerprint is one string, ``root|section|section...`` with a section as
``hash:paragraph,paragraph`` and a paragraph as ``hash`` followed by ``.leaf`` for every piece. It shows
32 bits of each hash below the root, which are made from whole ones. Equal texts have equal fingerprints and equal roots test equality; where sections differ,
paragraphs tell which, and where those differ, pieces. The likeness of two fingerprints is the Dice
coefficient of their distinct leaves, 1 for equal roots and below 1 for others.

Null reads as the empty text, whose fingerprint is only its root; it is alike to itself (1) and to
nothing else (0). The next document goes by descending doc_id, then by hash of the text; a missing
doc_id comes last. A single document is its own next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postbud.session import stage

PIECE_WORDS = 8
PIECE = rf"\s*\S{{1,64}}(?:\s+\S{{1,64}}){{0,{PIECE_WORDS - 1}}}|\s+"
BUCKETS = 512
_LEAST = -(1 << 63)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fingerprint(text: Column) -> Column:
    def node(paragraph: Column) -> Column:
        """The paragraph's whole hash, and 32 bits of each of its leaves."""
        sentences = F.split(paragraph, r"(?<=[.!?])(?=\s)")
        cut = F.flatten(F.transform(sentences, lambda s: F.regexp_extract_all(s, F.lit(PIECE), F.lit(0))))

        def written(hashes: Column) -> Column:
            shown = F.transform(hashes, lambda h: F.substring(h, 1, 8))
            return F.concat_ws(".", F.array(F.md5(F.concat(F.lit("p"), F.array_join(hashes, "")))), shown)

        return _once(F.transform(cut, F.md5), written)

    paragraphs = F.transform(F.split(text, "\n"), node)
    # A paragraph that ends a section is followed by "|", others by ",".
    marked = F.transform(
        paragraphs,
        lambda p: F.concat(p, F.when(p.rlike("^(?:[048c]|[^.]*$)"), F.lit("|")).otherwise(F.lit(","))),
    )
    sections = F.filter(F.split(F.array_join(marked, ""), r"\|"), lambda s: F.length(s) > 0)

    def section(s: Column) -> Column:
        """The section's whole hash, from its paragraphs' without their leaves, and what is shown of them."""
        s = F.rtrim(s, F.lit(","))
        own = F.md5(F.concat(F.lit("s"), F.regexp_replace(s, r"\.[0-9a-f]{8}", "")))
        return F.concat(own, F.lit(":"), F.regexp_replace(s, "(^|,)([0-9a-f]{8})[0-9a-f]{24}", "$1$2"))

    def tree(nodes: Column) -> Column:
        root = F.sha2(F.array_join(F.transform(nodes, lambda s: F.substring(s, 1, 32)), ""), 256)
        shown = F.transform(nodes, lambda s: F.concat(F.substring(s, 1, 8), F.substr(s, F.lit(33))))
        return F.when(text == "", root).otherwise(F.concat_ws("|", F.array(root), shown))

    return _once(F.transform(sections, section), tree)


def leaves(print_: Column) -> Column:
    """Distinct leaf hashes of a fingerprint."""
    return F.array_distinct(F.regexp_extract_all(print_, F.lit(r"\.([0-9a-f]{8})"), F.lit(1)))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of the leaves of two fingerprints; 1 only if the roots are equal."""
    n = F.size(leaves(a)) + F.size(leaves(b))
    both = F.size(F.array_intersect(leaves(a), leaves(b)))
    dice = F.when(n > 0, F.least(2.0 * both / n, 1.0 - 1.0 / (n + 1))).otherwise(0.0)
    return F.when(F.substring(a, 1, 64) == F.substring(b, 1, 64), 1.0).otherwise(dice)


def edited(text: Column, after: Column) -> Column:
    """The last floor(n / 2) code points replaced by the first as many of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(after, F.lit(1), half))


def with_next(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Every document with the text and fingerprint of the next one by descending doc_id.

    Documents are shuffled once, into ranges of doc_id that hold about as many each; the first
    document of each range goes to the range above as well. No window spans all documents.
    """
    spark = docs.sparkSession
    n = min(buckets, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.select(F.col("did"))
    bounds = ids.agg(F.percentile_approx("did", [i / n for i in range(1, n)], 10_000)).head()[0]
    bounds = sorted(set(bounds or []))
    of = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("did"))) if bounds else F.lit(0)
    # One row a range, at most ``buckets``: its greatest doc_id, wanted by the next range above.
    tops = ids.select("did", of.alias("bucket")).groupBy("bucket").agg(F.max("did").alias("top"))
    tops = sorted((r["bucket"], r["top"]) for r in tops.collect())
    above = [(t, tops[(i + 1) % len(tops)][0]) for i, (_, t) in enumerate(tops)]
    wanted = F.array(*[F.struct(F.lit(t).alias("top"), F.lit(b).alias("goes")) for t, b in above])
    goes = F.filter(wanted, lambda w: w["top"] == F.col("did"))["goes"]
    own = F.struct(F.lit(True).alias("own"), of.alias("bucket"))
    sent = F.transform(goes, lambda b: F.struct(F.lit(False).alias("own"), b.alias("bucket")))
    if not above:
        return docs.select("*", F.lit(None).cast("string").alias("next_text"), F.lit(None).cast("string").alias("next_fingerprint"))
    dealt = docs.select("*", F.explode(F.concat(F.array(own), sent)).alias("to")).select("*", "to.own", "to.bucket").drop("to")
    # By range and not by hash, which would put several ranges in one task and none in others.
    dealt = dealt.repartitionByRange(len(tops), "bucket")
    # Within a range: its own rows in descending order, then what came from the range below.
    order = Window.partitionBy("bucket").orderBy(F.col("own").desc(), F.col("did").desc(), "fingerprint")
    led = dealt.select(
        "*", F.lead("text").over(order).alias("next_text"), F.lead("fingerprint").over(order).alias("next_fingerprint")
    )
    return led.where("own").drop("own", "bucket")


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row per document: its fingerprint, that of its edited text, and how alike both are, and the next."""
    docs = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("did"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("fingerprint", fingerprint(F.col("text")))
    pairs = with_next(docs).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        edited(F.col("text"), F.col("next_text")).alias("edit"),
        "fingerprint",
        "next_fingerprint",
    )
    pairs = pairs.withColumn("edited_fingerprint", fingerprint(F.col("edit")))
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2("edit", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
