"""WARC archives: write records, index them first, read selected ones back by coalesced ranges.

Every task writes one file of records, each a gzip member of its own, and returns an index row per
record: file, offset, length, URL and digest. Reading takes index rows, sorts them by place and joins
neighbouring ranges into single reads. File names hold the task attempt, so a task that runs again
writes another file, and only the file of the attempt that counts is in the index.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the largest page_id is a response
and the others are revisits of it; smaller payloads are all responses. Null payloads are empty; a missing
page_id is smaller than any other, and rows that repeat the largest page_id are responses all.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postbud.session import scratch_path, stage

GAP = 64 << 10
READ_BYTES = 4 << 20
_LEAST = -(1 << 63)
_NAMESPACE = uuid.UUID("9b1d1c1e-6a5b-4f6e-8f39-5f0f3a1f6a01")
_INDEX = "page_id long, file string, offset long, length long, url string, digest string"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record. A revisit keeps the HTTP head, whose length is that of the full payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": " ".join(url.split()),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Page-Id": "" if page_id is None else str(page_id),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": _REVISIT, "WARC-Refers-To": record_id(refers_to, digest), "X-Refers-To-Page": str(refers_to)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    if first != "WARC/1.1" or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("not a WARC record")
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        at = 0
        with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in batches:
                rows = []
                for page_id, url, html, refers_to in zip(*(batch[c] for c in ("page_id", "url", "html", "refers_to"))):
                    payload = (html.as_py() or "").encode()
                    digest, url = payload_digest(payload), url.as_py() or ""
                    data = record(page_id.as_py(), url, payload, digest, refers_to.as_py(), date)
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = packer.compress(data) + packer.flush()
                    out.write(member)
                    rows.append((page_id.as_py(), name, at, len(member), url, digest))
                    at += len(member)
                yield _batch(rows, _INDEX)

    return run


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], list(names))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str | None = None) -> DataFrame:
    """Write one file a task under ``folder``; returns the index, already stored."""
    date = date or f"{datetime.now(timezone.utc):%Y-%m-%dT%H:%M:%SZ}"
    pages = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumns({"_id": F.coalesce("page_id", F.lit(_LEAST)), "_sha1": F.sha1(F.col("html").cast("binary"))})
    # Who is revisited is settled on ids and digests alone; partial maxima come before the shuffle.
    keys = stage(
        pages.where(F.octet_length("html") >= min_bytes).select("_id", "_sha1").distinct(), "digests"
    )
    # Written out, so that the join by the digest of a very common payload is one of plain shuffles, which AQE splits.
    top = keys.groupBy("_sha1").agg(F.max("_id").alias("_top"), F.count("*").alias("_n")).where("_n > 1")
    top = stage(top.select("_sha1", "_top"), "tops")
    revisits = keys.join(top, "_sha1").where("_id != _top").select("_id", "_sha1", F.col("_top").alias("refers_to"))
    rows = pages.join(revisits, ["_id", "_sha1"], "left").select("page_id", "url", "html", "refers_to")
    return stage(rows.mapInArrow(_write(folder, date), _INDEX), "index")


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def ranges(rows: list[tuple[int, int]], gap: int = GAP, most: int = READ_BYTES) -> list[tuple[int, int, int]]:
    """(start, end, records) of reads that cover (offset, length) in order of offset."""
    out: list[list[int]] = []
    for offset, length in rows:
        if out and offset - out[-1][1] <= gap and offset + length - out[-1][0] <= most:
            out[-1][1] = max(out[-1][1], offset + length)
            out[-1][2] += 1
        else:
            out.append([offset, offset + length, 1])
    return [tuple(x) for x in out]


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = list(zip(*(batch[c].to_pylist() for c in ("file", "offset", "length", "digest"))))
            for file in dict.fromkeys(r[0] for r in rows):
                own = [r for r in rows if r[0] == file]
                with fs.open_input_file(f"{root}/{file}") as source:
                    at = 0
                    for start, end, n in ranges([r[1:3] for r in own]):
                        source.seek(start)
                        data = memoryview(source.read(end - start))
                        yield _batch(
                            [_row(data[o - start : o - start + size], digest) for _, o, size, digest in own[at : at + n]], _READ
                        )
                        at += n

    return run


def _row(member: memoryview, digest: str) -> tuple:
    fields, http, payload = parse(zlib.decompress(member, 31))
    kind, named = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if named != digest or kind == "response" and payload_digest(payload) != digest:
        raise ValueError(f"record of {fields['WARC-Target-URI']} is not what the index says")
    page, refers = fields["X-Page-Id"], fields.get("X-Refers-To-Page")
    return int(page) if page else None, int(http["Content-Length"]), named, kind, int(refers) if refers else None


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Records of the index rows given, checked against their digests."""
    placed = index.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(_read(folder), _READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """A row per page as read back from archives written to the shared folder."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
