"""Remove every byte covered by a long string that also starts elsewhere, by merging sorted suffix runs.

Texts are UTF-8 bytes (null: empty); strings of ``LENGTH`` bytes never cross documents. Of all suffixes only some
need sorting. In every string the ``GRAM``-byte gram of least hash is its anchor (each place, if it occurs more than once);
the choice depends on the string alone, so equal strings have equal anchors at equal offsets. An
anchor answers for the strings that chose it, about one position in 65 is one, and an anchor whose gram is
nowhere else has no equal string to find.

1. Anchors of all documents, with the hash of their gram; grams seen once drop out. A gram that one slice of
   texts holds several times sends one row to the others, so frequent ones are combined before the shuffle.
2. The suffixes at the remaining anchors (``LENGTH`` bytes, then the bytes before the anchor, backwards) are sorted
   in runs. Equal ones in a run settle each other and send one. Runs are cut by ranges of leading bytes
   and front-coded: the length of the prefix shared with the one before, and the rest.
3. For every range a loser tree merges the runs. It keeps for each head how long a prefix it shares with the last
   output, so known prefixes are not compared again, and gives out the shared prefix of neighbours. Strings
   at offset o before an anchor are equal within a stretch whose shared prefixes reach LENGTH - o, if the o bytes before are.
   Leading bytes that fill several ranges by themselves are a hot range, whose runs are dealt to as many tasks as it needs. Each of
   them settles what it holds twice, and sends one row for every string that it holds; a string that
   several of them sent is repeated too, which an aggregate over string hashes tells.
4. The bytes covered go back by document; overlaps are joined there.

Documents go by doc_id and a hash of the text. Repeated rows are documents of their own, so they remove each other whole if
they are long enough.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postbud.llm.text import BASE_INVERSE, mix, power, prefix_hash, slices
from postbud.session import stage

LENGTH = 200
GRAM = 72
REACH = LENGTH - GRAM  # bytes before an anchor that its strings may begin
SPAN = LENGTH + REACH
RUN = 1 << 16
RANGE = 50_000
ROUND = 11
HOT = 40  # a part's number holds its range in the lower bits, and above them its share of a hot range, from 1
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_LEAST = -(1 << 63)
_DOC = ["did", "digest"]


# ---- anchors


def _sliding(x: np.ndarray, width: int, of) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours, by doubling."""
    have, size = x, 1
    while 2 * size <= width:
        have = of(have[:-size], have[size:])
        size *= 2
    rest = width - size
    return of(have[: len(have) - rest], have[rest:]) if rest else have


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Place, gram hash, least and greatest offset of the strings that chose it, for all anchors of a slice."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none.astype(np.uint64), none, none
    sums = prefix_hash(data)
    gram = mix((sums[GRAM:] - sums[:-GRAM]) * power(BASE_INVERSE, len(sums))[: len(sums) - GRAM])
    gram = np.minimum(np.maximum(gram, np.uint64(1)), _NONE - np.uint64(1))
    least = _sliding(gram, REACH + 1, np.minimum)  # by the string's start
    valid = np.zeros(len(least), bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        valid[a : max(b - LENGTH + 1, a)] = True
    least[~valid] = 0
    padded = np.concatenate((np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)))
    at = np.flatnonzero(_sliding(padded, REACH + 1, np.maximum)[: len(gram)] == gram)
    # The strings of an anchor are the stretch of equal minima within reach.
    start = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    end = np.append(start[1:], len(least))
    first, last = np.maximum(at - REACH, 0), np.minimum(at, len(least) - 1)
    segment = np.searchsorted(start, first, "right") - 1
    open_ = np.arange(len(at))
    while len(open_ := open_[least[start[segment[open_]]] != gram[at[open_]]]):
        segment[open_] += 1
    low = at - np.minimum(end[segment] - 1, last)
    high = at - np.maximum(start[segment], first)
    return at, gram[at], low, high


def _lead(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from a place on, as integers in the order of the bytes."""
    out = np.zeros(len(at), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | data[at + j].astype(np.uint64)
    return (out ^ np.uint64(1 << 63)).view(np.int64)


_ANCHORS = "key long, settled boolean, did long, digest long, place int, low short, high short, lead long"


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        did, digest = (batch[c].to_numpy() for c in _DOC)
        for first, data, offsets in slices(batch["text"]):
            at, gram, low, high = anchors(data, offsets)
            row = np.searchsorted(offsets, at, "right") - 1
            _, one, back, n = np.unique(gram, return_index=True, return_inverse=True, return_counts=True)
            settled = n[back] > 1
            # Of a gram that is here several times one row is dealt by its hash, the rest anywhere.
            key = np.where(np.isin(np.arange(len(at)), one), gram, mix(gram + at.astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)), pa.array(settled), pa.array(did[first + row]), pa.array(digest[first + row]),
                    pa.array((at - offsets[row]).astype(np.int32)), pa.array(low.astype(np.int16)), pa.array(high.astype(np.int16)),
                    pa.array(_lead(data, at)),
                ],
                [c.split()[0] for c in _ANCHORS.split(", ")],
            )


_KEPT = "did long, digest long, place int, low short, high short, lead long"


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose key is there twice, or that are settled; rows come sorted by key."""
    names = [c.split()[0] for c in _KEPT.split(", ")]
    held = None  # the last row, whose successor is not known yet, and whether it equals its predecessor
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held[0], batch]).combine_chunks().to_batches()[0]
        key = batch["key"].to_numpy()
        same = np.concatenate(([False if held is None else held[1]], key[1:] == key[:-1]))
        keep = same | batch["settled"].to_numpy(zero_copy_only=False)
        keep[:-1] |= same[1:]
        held = batch.slice(batch.num_rows - 1), bool(same[-1])
        yield batch.slice(0, batch.num_rows - 1).select(names).filter(pa.array(keep[:-1]))
    if held is not None:
        keep = held[1] or held[0]["settled"][0].as_py()
        yield held[0].select(names).slice(0, int(keep))


# ---- runs


def _sort_rows(strings: np.ndarray) -> np.ndarray:
    return np.argsort(strings.view(f"S{strings.shape[1]}").reshape(-1), kind="stable")


def _shared(strings: np.ndarray) -> np.ndarray:
    """Length of the prefix each row shares with the one before."""
    out = np.zeros(len(strings), np.int32)
    if len(strings) > 1:
        differ = strings[1:] != strings[:-1]
        out[1:] = np.where(differ.any(1), differ.argmax(1), strings.shape[1])
    return out


def encode(strings: np.ndarray, meta: np.ndarray) -> bytes:
    """Front-code sorted rows; ``meta`` are four integers a row."""
    shared = _shared(strings)
    rest = strings[np.arange(strings.shape[1]) >= shared[:, None]]
    body = shared.astype(np.int16).tobytes() + meta.astype(np.int64).tobytes() + rest.tobytes()
    return len(strings).to_bytes(4, "little") + zlib.compress(body, 1)


def decode(blob: bytes) -> tuple[list[bytes], list[int], np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    body = zlib.decompress(blob[4:])
    shared = np.frombuffer(body, np.int16, n).tolist()
    meta = np.frombuffer(body, np.int64, 4 * n, 2 * n).reshape(n, 4)
    at, strings, last = 34 * n, [], b""
    for p in shared:
        last = last[:p] + body[at : at + SPAN - p]
        at += SPAN - p
        strings.append(last)
    return strings, shared, meta


def _contexts(text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For every place the bytes from it on, then those before it backwards; zeros beyond the text."""
    padded = np.concatenate((np.zeros(REACH, np.uint8), text, np.zeros(LENGTH, np.uint8)))
    step = np.concatenate((np.arange(LENGTH), -1 - np.arange(REACH)))
    return padded[(place + REACH)[:, None] + step]


_PARTS = "part long, blob binary"


def _make_runs(bounds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, ways = bounds.value
        strings, meta, waiting, salt = [], [], 0, 0
        for batch in batches:
            for did, digest, text, at in zip(*(batch[c] for c in [*_DOC, "text", "at"])):
                data = np.frombuffer(text.as_py().encode(), np.uint8)
                rows = at.values
                place, low, high = (rows.field(c).to_numpy() for c in ("place", "low", "high"))
                own = np.empty((len(place), 4), np.int64)
                own[:, 0], own[:, 1], own[:, 2] = did.as_py(), digest.as_py(), place
                own[:, 3] = low.astype(np.int64) << 16 | high
                # A document of any length passes in parts, so memory stays bounded.
                for a in range(0, len(place), RUN):
                    strings.append(_contexts(data, place[a : a + RUN].astype(np.int64)))
                    meta.append(own[a : a + RUN])
                    waiting += len(strings[-1])
                    if waiting >= RUN:
                        yield _run_rows(np.concatenate(strings), np.concatenate(meta), cuts, ways, salt := salt + 1)
                        strings, meta, waiting = [], [], 0
        if waiting:
            yield _run_rows(np.concatenate(strings), np.concatenate(meta), cuts, ways, salt + 1)

    return run


def _run_rows(strings: np.ndarray, meta: np.ndarray, cuts: np.ndarray, ways: np.ndarray, salt: int) -> pa.RecordBatch:
    order = _sort_rows(strings)
    strings, meta = strings[order], meta[order]
    equal = np.concatenate(([False], (strings[1:] == strings[:-1]).all(1) & (meta[1:, 3] == meta[:-1, 3])))
    twice = equal | np.append(equal[1:], False)
    settled = _spans(meta[twice], meta[twice, 3] >> 16, meta[twice, 3] & 0xFFFF)
    strings, meta = strings[~equal], meta[~equal]
    part = np.searchsorted(cuts, _lead_of(strings), "right")
    ends = np.flatnonzero(np.append(part[1:] != part[:-1], True)) + 1
    parts, blobs, a = [], [], 0
    for b in ends.tolist():
        number, shares = int(part[a]), int(ways[part[a]])
        if shares > 1:
            # A run of a hot range is cut too, so that no share gets much more than another.
            size = -(-RUN // shares)
            for c in range(a, b, size):
                dealt = mix(np.array([salt + c, meta[c, 1]], np.int64).view(np.uint64)).sum()
                parts.append(number + ((1 + int(dealt % np.uint64(shares))) << HOT))
                blobs.append(encode(strings[c : min(c + size, b)], meta[c : min(c + size, b)]))
        else:
            parts.append(number)
            blobs.append(encode(strings[a:b], meta[a:b]))
        a = b
    if len(settled):
        # What is settled only passes through; it is dealt evenly.
        parts.append(-1 - int(mix(np.array([settled[0, 0] + salt], np.int64).view(np.uint64))[0] >> np.uint64(2)))
        blobs.append(settled.tobytes())
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(blobs, pa.binary())], ["part", "blob"])


def _lead_of(strings: np.ndarray) -> np.ndarray:
    return (np.ascontiguousarray(strings[:, :8]).view(">u8").reshape(-1).astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def _spans(meta: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """did, digest, first and last byte + 1 covered by the strings at offsets low to high before an anchor."""
    return np.stack([meta[:, 0], meta[:, 1], meta[:, 2] - high, meta[:, 2] - low + LENGTH], 1)


# ---- merge


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs; gives the run of every output and the prefix it shares with the output before.

    ``ahead[r]`` is how long a prefix the head of run r shares with the last string that passed it. The
    longer one comes first; only when both are equal are bytes compared, and from there on.
    """
    width = 1 << max(len(runs) - 1, 0).bit_length()
    head: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (width - len(runs))
    ahead = [0 if s is not None else -1 for s in head]
    losers, place = [0] * width, [0] * len(runs)

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared prefix is then with the winner."""
        p = ahead[a]
        if p != ahead[b]:
            return (a, b) if p > ahead[b] else (b, a)
        if p < 0:
            return a, b
        x, y = head[a][p:], head[b][p:]
        if x == y:
            ahead[b] = p + len(x)
            return a, b
        differ = int.from_bytes(x) ^ int.from_bytes(y)
        both = p + len(x) - (differ.bit_length() + 7) // 8
        if x < y:
            ahead[b] = both
            return a, b
        ahead[a] = both
        return b, a

    winners = list(range(width))
    level = width
    while level > 1:
        level //= 2
        for i in range(level):
            winners[i], losers[level + i] = play(winners[2 * i], winners[2 * i + 1])
    best, order, shared = winners[0], [], []
    while head[best] is not None:
        order.append(best)
        shared.append(ahead[best])
        strings, known = runs[best]
        i = place[best] = place[best] + 1
        if i < len(strings):
            head[best], ahead[best] = strings[i], known[i]
        else:
            head[best], ahead[best] = None, -1
        node = (best + width) >> 1
        while node:
            best, losers[node] = play(best, losers[node])
            node >>= 1
    return order, shared


def repeated_offsets(strings: np.ndarray, shared: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For merged rows, whether the string at each offset before the anchor is in another row."""
    n = len(strings)
    out = np.zeros((n, REACH + 1), bool)
    near = np.minimum(shared, LENGTH)
    most = np.maximum(near, np.append(near[1:], 0))
    before = np.zeros(n, np.uint64)
    for o in range(REACH + 1):
        if o:
            before = mix(before + strings[:, LENGTH + o - 1].astype(np.uint64) + np.uint64(1))
        own = np.flatnonzero((low <= o) & (o <= high) & (most >= LENGTH - o))
        if len(own) < 2:
            continue
        stretch = np.cumsum(near < LENGTH - o).astype(np.uint64)
        key = mix(before + stretch * np.uint64(0x9E3779B97F4A7C15))[own]
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        out[own[order], o] = np.concatenate(([False], same)) | np.append(same, False)
    return out


def string_hashes(strings: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every offset before the anchor: it, the rows that have a string there, and the strings' hashes."""
    ahead, lengths = np.zeros(len(strings), np.uint64), {}
    for k in range(LENGTH):
        ahead = mix(ahead + strings[:, k].astype(np.uint64) + np.uint64(1))
        if k + 1 >= GRAM:
            lengths[k + 1] = ahead
    before = np.zeros(len(strings), np.uint64)
    for o in range(REACH + 1):
        if o:
            before = mix(before + strings[:, LENGTH + o - 1].astype(np.uint64) + np.uint64(1))
        own = np.flatnonzero((low <= o) & (o <= high))
        yield o, own, mix(lengths[LENGTH - o][own] + before[own] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(o))


#: ``string`` is the hash of a string of a hot range that this share holds, and the bytes are those of its only place there.
_SPANS = "did long, digest long, first long, past long, string long"


def _held_strings(strings: np.ndarray, meta: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Table:
    """A row per different string; those held once come with their place, for others that is settled."""
    out = [_span_table(np.zeros((0, 4), np.int64))]
    for o, own, key in string_hashes(strings, low, high):
        key, at, n = np.unique(key, return_index=True, return_counts=True)
        row = own[at]
        offset = np.full(len(row), o)
        out.append(_span_table(_spans(meta[row], offset, offset), key.view(np.int64), n > 1))
    return pa.concat_tables(out)


def _merge_range(table: pa.Table) -> pa.Table:
    blobs = table["blob"].to_pylist()
    number = table["part"][0].as_py()
    if number < 0:
        return _span_table(np.concatenate([np.frombuffer(b, np.int64).reshape(-1, 4) for b in blobs]))
    runs = [decode(b) for b in blobs]
    order, shared = merge([r[:2] for r in runs])
    order = np.array(order)
    # The rows of a run come out in its order.
    at = np.argsort(np.argsort(order, kind="stable"), kind="stable")
    strings = np.frombuffer(b"".join(s for r in runs for s in r[0]), np.uint8).reshape(-1, SPAN)[at]
    meta = np.concatenate([r[2] for r in runs])[at]
    low, high = meta[:, 3] >> 16, meta[:, 3] & 0xFFFF
    again = np.pad(repeated_offsets(strings, np.array(shared), low, high), ((0, 0), (1, 1)))
    row, first = np.nonzero(again[:, 1:] & ~again[:, :-1])
    _, past = np.nonzero(again[:, :-1] & ~again[:, 1:])
    settled = _span_table(_spans(meta[row], first, past - 1))
    return pa.concat_tables([settled, _held_strings(strings, meta, low, high)]) if number >> HOT else settled


def _span_table(spans: np.ndarray, string: np.ndarray | None = None, without_place: np.ndarray | None = None) -> pa.Table:
    names = [c.split()[0] for c in _SPANS.split(", ")]
    columns = [pa.array(spans[:, i].copy(), pa.int64(), mask=without_place) for i in range(4)]
    return pa.table(dict(zip(names, [*columns, pa.nulls(len(spans), pa.int64()) if string is None else pa.array(string)])))


# ---- whole


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("did"),
        F.xxhash64(text).alias("digest"), text.alias("text"),
    )


def _cuts(kept: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Leading bytes at which ranges begin, and into how many shares each range goes (1 but for hot ones)."""
    n = kept.count()
    if n <= RANGE:
        return np.zeros(0, np.int64), np.ones(1, np.int64)
    parts = -(-n // RANGE)
    # Quantiles are doubles, so they are taken of as many bits as a double holds.
    lead = F.shiftright("lead", ROUND)
    found = kept.agg(F.percentile_approx(lead, [i / parts for i in range(1, parts)], max(10_000, 4 * parts))).head()[0]
    found, times = np.unique(np.array(found, np.int64), return_counts=True)
    # One that several cuts fall on fills the ranges between them, and is a range of its own.
    hot, shares = found[times > 1] << ROUND, times[times > 1] + 1
    cuts = np.union1d(found << ROUND, hot + (1 << ROUND))
    ways = np.ones(len(cuts) + 1, np.int64)
    ways[np.searchsorted(cuts, hot, "right")] = shares
    return cuts, ways


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``did``, ``digest``, ``first``, ``past``: stretches of bytes that long repeated strings cover; they may overlap."""
    spark = docs.sparkSession
    keyed = _keyed(docs).select(*_DOC, "text")
    kept = stage(
        keyed.mapInArrow(_find_anchors, _ANCHORS).repartition("key").sortWithinPartitions("key").mapInArrow(_repeated, _KEPT),
        "anchors",
    )
    cuts, ways = _cuts(kept)
    listed = kept.groupBy(*_DOC).agg(F.collect_set(F.struct("place", "low", "high")).alias("at"))
    runs = keyed.join(listed, _DOC).select(*_DOC, "text", "at").mapInArrow(_make_runs(spark.sparkContext.broadcast((cuts, ways))), _PARTS)
    spans = stage(runs.groupBy("part").applyInArrow(_merge_range, _SPANS), "spans")
    settled = spans.where("string IS NULL").drop("string")
    if not (ways > 1).any():
        return settled
    # A share sends a string once, so there are at most as many rows of one as shares.
    held = spans.where("string IS NOT NULL")
    several = held.groupBy(F.col("string").alias("_string")).agg(F.count("*").alias("n")).where("n > 1")
    more = held.where("did IS NOT NULL").join(several, F.col("string") == F.col("_string"), "left_semi").drop("string")
    return stage(settled.unionByName(more), "all_spans")


def remove(data: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """Remaining bytes, bytes removed, and maximal removed stretches; spans are (first, past)."""
    if not len(spans):
        return data, 0, 0
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate(([True], spans[1:, 0] > reach[:-1])))
    first, past = spans[new, 0], reach[np.append(new[1:], len(spans)) - 1]
    kept = [data[a:b] for a, b in zip([0, *past.tolist()], [*first.tolist(), len(data)])]
    return b"".join(kept), int((past - first).sum()), len(new)


_DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch["text"], batch["spans"]):
            data = text.as_py().encode()
            own = np.zeros((0, 2), np.int64)
            if spans.is_valid:
                own = np.stack([spans.values.field(c).to_numpy() for c in ("first", "past")], 1)
            kept, removed, n = remove(data, own)
            rows.append((len(data), removed, n, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*rows)) if rows else [[]] * 4
        names = [c.split()[0] for c in _DIGESTS.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names
        )


def suffix_dedup_digests(docs: DataFrame) -> DataFrame:
    """A row per document: bytes, bytes removed, stretches removed, SHA-256 of what remains."""
    spans = repeated_spans(docs).groupBy(*_DOC).agg(F.collect_list(F.struct("first", "past")).alias("spans"))
    return _keyed(docs).join(spans, _DOC, "left").select("doc_id", "text", "spans").mapInArrow(_digests, _DIGESTS)
