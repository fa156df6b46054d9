"""Drop lines that many documents share, by a range-partitioned stream over line hashes.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased. Keys of at least
``MIN_CHARS`` code points found in at least ``MIN_DOCS`` documents lose all their lines except in
the largest doc_id that holds them. Texts split at line feeds; null and empty texts are one empty line.

The 128-bit hashes of keys are range-partitioned with their documents, sorted by hash, document
(descending) and position, and streamed: the first document of a hash keeps its lines. As document
is part of the range, a very frequent line spreads over many partitions; the groups that a
partition begins or ends with are settled afterwards from one count per partition. Documents go
by doc_id and a hash of the text, and repeated rows are one document. A missing doc_id is
smaller than any other; each text without doc_id is a document of its own, and the largest of them is that of the largest hash. What comes back is a compressed bitmap a document, never text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postbud.session import stage

MIN_CHARS = 40
MIN_DOCS = 5
BLANK = " \t\n\v\f\r"
_LEAST = -(1 << 63)
_KEY = ["h1", "h2"]
_DOC = ["did", "digest"]


def _hash_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, doc, digest, place = bytearray(), [], [], []
            for did, dig, text in zip(batch["did"].to_pylist(), batch["digest"].to_pylist(), batch["text"]):
                text = text.as_py()
                if len(text) < min_chars:
                    continue
                for i, line in enumerate(text.split("\n")):
                    line = line.strip(BLANK)
                    if len(line) >= min_chars:
                        found += hashlib.blake2b(line.encode().lower(), digest_size=16).digest()
                        doc.append(did)
                        digest.append(dig)
                        place.append(i)
            halves = np.frombuffer(bytes(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict(
                {
                    "h1": pa.array(halves[:, 0].copy()),
                    "h2": pa.array(halves[:, 1].copy()),
                    "did": pa.array(doc, pa.int64()),
                    "digest": pa.array(digest, pa.int64()),
                    "place": pa.array(place, pa.int32()),
                }
            )

    return run


_STREAMED = "kind string, h1 long, h2 long, did long, digest long, place int, n long"


def _stream(min_docs: int):
    """Rows of kind ``drop`` (settled), ``edge`` (to be settled) and ``sum`` (documents of an edge; ``digest`` is the top one's ``sub``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, top, last, n, pending, first_group = None, None, None, 0, [], True

        def close(at_end: bool):
            if key is not None and (first_group or at_end):
                out.append(("sum", *key, *top, 0, n))
                out.extend(("edge", *key, *row, 0) for _, row in pending)

        for batch in batches:
            for h1, h2, did, sub, digest, place in zip(*(batch[c].to_pylist() for c in [*_KEY, "did", "sub", "digest", "place"])):
                if key is None or h1 != key[0] or h2 != key[1]:
                    if key is not None:
                        close(False)
                        first_group = False
                    key, top, last, n, pending = (h1, h2), (did, sub), None, 0, []
                if (did, sub) != last:
                    last, n = (did, sub), n + 1
                if first_group:
                    out.append(("edge", h1, h2, did, digest, place, 0))
                elif n < min_docs:
                    pending.append((last, (did, digest, place)))
                else:
                    if pending:
                        out.extend(("drop", h1, h2, *row, 0) for doc, row in pending if doc != top)
                        pending = []
                    out.append(("drop", h1, h2, did, digest, place, 0))
            yield _rows(out)
            out.clear()
        close(True)
        yield _rows(out)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in range(7)]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    names = ["kind", *_KEY, *_DOC, "place", "n"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _keyed(docs: DataFrame) -> list:
    text = F.coalesce(docs["text"], F.lit(""))
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(_LEAST)).alias("did"), F.xxhash64(text).alias("digest"), text.alias("text")]


@F.pandas_udf(T.BinaryType())
def _bitmap(places: pd.Series) -> pd.Series:
    def pack(at) -> bytes:
        keep = np.ones(max(at) // 8 * 8 + 8, bool)  # whole bytes
        keep[np.asarray(at)] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return places.map(pack)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``did``, ``digest``, ``bitmap`` of documents that lose lines: compressed bits, 1 keeps a line.

    Lines beyond the bits are kept.
    """
    lines = stage(
        docs.select(*_keyed(docs)).mapInArrow(
            _hash_lines(min_chars), "h1 long, h2 long, did long, digest long, place int"
        ),
        "lines",
    )
    # What tells documents without doc_id apart.
    sub = F.when(F.col("did") == _LEAST, F.col("digest")).otherwise(0)
    order = ["h1", "h2", F.col("did").desc(), F.col("sub").desc()]
    streamed = stage(
        lines.withColumn("sub", sub).repartitionByRange(*order)
        .sortWithinPartitions(*order, "place")
        .mapInArrow(_stream(min_docs), _STREAMED),
        "streamed",
    )
    # At most two rows for each partition of the stream.
    frequent = (
        streamed.where("kind = 'sum'").groupBy(*_KEY).agg(F.sum("n").alias("docs"), F.max(F.struct("did", F.col("digest").alias("sub"))).alias("top"))
        .where(F.col("docs") >= min_docs)
    )
    settled = (
        streamed.where("kind = 'edge'").join(F.broadcast(frequent), _KEY).where((F.col("did") != F.col("top.did")) | (sub != F.col("top.sub"))).select(*_DOC, "place")
    )
    dropped = streamed.where("kind = 'drop'").select(*_DOC, "place").union(settled)
    listed = dropped.groupBy(*_DOC).agg(F.collect_list("place").alias("places"))
    return listed.select(*_DOC, _bitmap("places").alias("bitmap"))


def kept_lines(text: str, bitmap: bytes | None) -> tuple[str, int, int]:
    """The remaining text, the number of lines before, and the number of lines dropped."""
    if bitmap is None:
        return text, text.count("\n") + 1, 0
    lines = text.split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
    kept = [x for i, x in enumerate(lines) if i >= len(keep) or keep[i]]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def _with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    keys = [c.alias(f"_{name}") for c, name in zip(_keyed(docs), ("did", "digest", "text"))]
    marks = bitmaps.select(F.col("did").alias("_did"), F.col("digest").alias("_digest"), F.col("bitmap").alias("_bitmap"))
    return docs.select("*", *keys).join(marks, ["_did", "_digest"], "left")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [kept_lines(t.as_py(), b.as_py()) for t, b in zip(batch["_text"], batch["_bitmap"])]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch["doc_id"],
                "n_lines": pa.array([n for _, n, _ in found], pa.int64()),
                "n_dropped": pa.array([n for _, _, n in found], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t, _, _ in found], pa.string()),
            }
        )


def line_dedup_digests(docs: DataFrame) -> DataFrame:
    """A row per document: lines before, lines dropped, SHA-256 of the remaining text."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    return _with_bitmaps(docs, keep_bitmaps(docs)).select("doc_id", "_text", "_bitmap").mapInArrow(
        _digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )


@F.pandas_udf(T.StringType())
def _remaining(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    return pd.Series([kept_lines(t, b)[0] for t, b in zip(text, bitmap)])


def drop_repeated_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without the lines that other documents repeat; all rows and columns stay.

    ``n_chars`` is the length of the remaining text where the table has that column.
    """
    columns = docs.columns
    joined = _with_bitmaps(docs, keep_bitmaps(docs))
    left = joined.withColumn("_kept", F.when(F.col("_bitmap").isNull(), F.col("text")).otherwise(_remaining("_text", "_bitmap")))
    out = [F.col("_kept").alias("text") if c == "text" else F.col(c) for c in columns]
    if "n_chars" in columns:
        out[columns.index("n_chars")] = (
            F.when(F.col("_bitmap").isNull(), F.col("n_chars")).otherwise(F.length("_kept")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
        )
    return left.select(*out)


ORACLE = """
WITH lines AS (
  SELECT doc_id, i, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM documents
  )
), frequent AS (
  SELECT key, max(doc_id) AS top FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT lines.doc_id, i, line, frequent.key IS NOT NULL AND lines.doc_id <> top AS gone
  FROM lines LEFT JOIN frequent ON lines.key = frequent.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
