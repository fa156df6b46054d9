"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

Five-word shingles (words are runs without ASCII white space, lower-cased) weigh their count in the
text times an idf. Shingles in at most ``RARE`` of all documents share the full idf of 1; above that
it falls with the logarithm of the document frequency to 1/2. Near copies found in large groups so
keep their likeness, while passages that many documents share count for less.

* Document frequencies: shingles above the threshold are few (at most the average length over
  ``RARE``, whatever the corpus size). A Misra-Gries summary of one size per task, merged in a
  tree, holds all of them; if texts turn out too long for its size, it is taken again at one that follows from their length; a second pass counts the held ones exactly over all documents.
* Every text gets ``BANDS`` x ``ROWS`` samples; texts that agree in a whole band are candidates.
* Within a band's bucket texts are first held against one pivot, so a large group of near copies costs one
  comparison a member. Buckets that are one class then are done. In the others all members are compared, in
  sub-blocks of ``MEMBERS`` times ``MEMBERS`` that tasks share, but members of the largest class only with the rest,
  and only links come out; a pair is compared in the first bucket it shares. Four bits of every sample
  are compared first: a pair that differs in more than ``DIFFER`` of them is passed over (at
  likeness 0.8 nine are expected, and fewer than one pair in a thousand has more than that).
  The others are verified by weighted Jaccard likeness on their whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postbud.llm.components import components
from postbud.llm.text import mix, shingles, slices
from postbud.session import stage

THRESHOLD = 0.8
DIFFER = 20
BITS = 4
BANDS, ROWS = 12, 4
RARE = 0.01
SUMMARY = 1 << 17
LEVELS = 1 << 16
MEMBERS = 512
BLOCK_BYTES = 8 << 20


# ---- document frequencies


def _merge(keys: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Add up counts of equal keys; keep ``size`` keys, less what the first left out has."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    keys, counts = keys[new], np.add.reduceat(counts, new)
    if len(keys) > size:
        counts = counts - np.partition(counts, len(counts) - size - 1)[len(counts) - size - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def _summaries(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, pending = np.zeros(0, np.uint64), np.zeros(0, np.int64), []
        n, waiting, total = 0, 0, 0

        def flush():
            nonlocal keys, counts, pending, waiting
            found = [keys, *pending]
            keys, counts = _merge(
                np.concatenate(found),
                np.concatenate([counts, np.ones(waiting, np.int64)]),
                size,
            )
            pending, waiting = [], 0

        for batch in batches:
            n += batch.num_rows
            for _, data, offsets in slices(batch["text"], lower=True):
                _, key, _ = shingles(data, offsets)
                pending.append(key)
                waiting += len(key)
                total += len(key)
                if waiting > 4 << 20:
                    flush()
        flush()
        yield _summary_row(TaskContext.get().partitionId(), keys, counts, n, total)

    return run


def _summary_row(slot: int, keys: np.ndarray, counts: np.ndarray, n: int, total: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "slot": pa.array([slot], pa.int64()),
            "keys": pa.array([keys.tobytes()], pa.binary()),
            "counts": pa.array([counts.astype(np.int64).tobytes()], pa.binary()),
            "n": pa.array([n], pa.int64()),
            "total": pa.array([total], pa.int64()),
        }
    )


_SUMMARY_SCHEMA = "slot long, keys binary, counts binary, n long, total long"


def _merge_rows(size: int):
    """Merge summaries one after the other; the state is never more than two of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, n, total = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _merge(
                    np.concatenate([keys, np.frombuffer(row["keys"], np.uint64)]),
                    np.concatenate([counts, np.frombuffer(row["counts"], np.int64)]),
                    size,
                )
                n += row["n"]
                total += row["total"]
        yield _summary_row(0, keys, counts, n, total)

    return run


def _count_held(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = held.value
        counts = np.zeros(len(keys), np.int64)
        for batch in batches:
            for _, data, offsets in slices(batch["text"], lower=True):
                _, key, _ = shingles(data, offsets)
                at = np.searchsorted(keys, key)
                at[at == len(keys)] = 0
                counts += np.bincount(at[keys[at] == key], minlength=len(keys))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"key": keys[some].view(np.int64), "df": counts[some]}
        )

    return run


def _summarised(docs: DataFrame, size: int):
    """The summary of all documents, one row."""
    local = stage(docs.select("text").mapInArrow(_summaries(size), _SUMMARY_SCHEMA), "summaries")
    while (parts := local.rdd.getNumPartitions()) > 8:
        local = stage(
            local.coalesce(-(-parts // 8)).mapInArrow(_merge_rows(size), _SUMMARY_SCHEMA), "summaries"
        )
    return local.coalesce(1).mapInArrow(_merge_rows(size), _SUMMARY_SCHEMA).head()


def common_shingles(
    docs: DataFrame, rare: float = RARE, size: int = SUMMARY
) -> tuple[np.ndarray, np.ndarray, int]:
    """Shingles found in more than ``rare`` of all documents, their idf, and the number of documents.

    A summary holds every shingle in more documents than 1 / ``size`` of the number of distinct shingles summed
    over documents. If that is more than ``rare``, it is taken again at the size the measured number asks for, so
    all are held. At most as many rows come to the driver: about the average number a document over ``rare``.
    """
    spark = docs.sparkSession
    last = _summarised(docs, size)
    if last and last["n"] and (needed := math.ceil(last["total"] / (rare * last["n"]))) > size:
        last = _summarised(docs, needed)
    n = last["n"] if last else 0
    held = np.sort(np.frombuffer(last["keys"], np.uint64)) if last else np.zeros(0, np.uint64)
    if not len(held):
        return held, np.zeros(0), n
    counted = (
        docs.select("text")
        .mapInArrow(_count_held(spark.sparkContext.broadcast(held)), "key long, df long")
        .groupBy("key")
        .agg(F.sum("df").alias("df"))
        .where(F.col("df") > rare * n)
        .toPandas()
    )
    key = counted["key"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    df = counted["df"].to_numpy()[order].astype(float)
    return key[order], 0.5 + 0.5 * np.log(n / df) / np.log(1 / rare), n


def _weights(key: np.ndarray, count: np.ndarray, common: tuple) -> np.ndarray:
    keys, idf = common
    if not len(keys):
        return count.astype(np.float32)
    at = np.searchsorted(keys, key)
    at[at == len(keys)] = 0
    return (count * np.where(keys[at] == key, idf[at], 1.0)).astype(np.float32)


# ---- samples


def _gamma2(u: np.ndarray) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution by Newton's method on its logarithm."""
    x = np.maximum(np.sqrt(2 * u), -np.log1p(-u))
    for _ in range(60):
        f = 1 - np.exp(-x) * (1 + x) - u
        x = np.maximum(x - f / np.maximum(x * np.exp(-x), 1e-300), x / 4)
    return x


_LEVEL = (np.arange(LEVELS) + 0.5) / LEVELS
_R = _gamma2(_LEVEL).astype(np.float32)
_LOG_C = np.log(_gamma2(_LEVEL)).astype(np.float32)


def samples(row: np.ndarray, key: np.ndarray, weight: np.ndarray, rows: int, count: int) -> np.ndarray:
    """``count`` consistent weighted samples for each of ``rows`` texts; texts without shingles: 0.

    The sample k of a text is the shingle of least a = c / (y exp r), with its level t, where
    t = floor(ln S / r + beta) and ln y = r (t - beta) for weight S, as in the published scheme;
    r, c and beta come from the hash of shingle and k.
    """
    out = np.zeros((count, rows), np.uint64)
    if not len(row):
        return out
    start = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    size = np.diff(np.append(start, len(row)))
    texts = row[start]
    log_s = np.log(weight)
    low = np.uint64(LEVELS - 1)
    for k in range(count):
        h = mix(key + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        r = _R[(h & low).astype(np.int32)]
        beta = (h >> np.uint64(32)).astype(np.uint32).astype(np.float32)
        beta *= np.float32(2.0**-32)
        t = np.floor(log_s / r + beta)
        a = _LOG_C[((h >> np.uint64(16)) & low).astype(np.int32)] - r * (t - beta + 1)
        least = np.minimum.reduceat(a, start)
        hit = np.flatnonzero(a == np.repeat(least, size))
        first = hit[np.searchsorted(hit, start)]
        out[k, texts] = mix(key[first] + t[first].astype(np.int64).view(np.uint64) * np.uint64(0x632BE59BD9B4E019))
    return out


def bands(sample: np.ndarray, n_bands: int, n_rows: int) -> np.ndarray:
    out = np.zeros((n_bands, sample.shape[1]), np.uint64)
    for b in range(n_bands):
        for r in range(n_rows):
            out[b] = mix(out[b] * np.uint64(31) + sample[b * n_rows + r] + np.uint64(b + 1))
    return out.view(np.int64)


def sample_bits(sample: np.ndarray) -> list[np.ndarray]:
    """``BITS`` integers a text; bit k of the j-th is bit j of sample k. Takes up to 64 samples."""
    out = []
    for j in range(BITS):
        bits = np.zeros(sample.shape[1], np.uint64)
        for k, one in enumerate(sample):
            bits |= ((one >> np.uint64(20 + j)) & np.uint64(1)) << np.uint64(k)
        out.append(bits.view(np.int64))
    return out


def _sign(common, n_bands: int, n_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"]
            for first, data, offsets in slices(texts, lower=True):
                n = len(offsets) - 1
                row, key, count = shingles(data, offsets)
                weight = _weights(key, count, common.value)
                total = np.bincount(row, weight, minlength=n)
                drawn = samples(row, key, weight, n, n_bands * n_rows)
                found = bands(drawn, n_bands, n_rows)
                flat = pa.array(found.T.reshape(-1))
                lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * n_bands, flat)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, n), batch["digest"].slice(first, n), pa.array(total), lists,
                     *map(pa.array, sample_bits(drawn))],
                    ["doc_id", "digest", "total", "bands", *_BITS],
                )

    return run


# ---- verification


def _verify(common):
    def run(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        a, b = pairs["a"].to_numpy(), pairs["b"].to_numpy()
        found = block_likeness(a, b, texts["node"].to_numpy(), texts["text"], common.value)
        return pa.table({"a": a, "b": b, "likeness": found})

    return run


def block_likeness(a: np.ndarray, b: np.ndarray, nodes: np.ndarray, texts: pa.ChunkedArray, common: tuple) -> np.ndarray:
    """Weighted Jaccard likeness of pairs of nodes, all partners of a frequent node at once."""
    rows, keys, weights = [], [], []
    for first, data, offsets in slices(texts, lower=True):
        row, key, count = shingles(data, offsets)
        rows.append(row + first)
        keys.append(key)
        weights.append(_weights(key, count, common).astype(np.float64))
    row, weight = np.concatenate(rows), np.concatenate(weights)
    _, term = np.unique(np.concatenate(keys), return_inverse=True)
    end = np.searchsorted(row, np.arange(len(nodes) + 1))
    total = np.bincount(row, weight, minlength=len(nodes))
    order = np.argsort(nodes)
    x, y = (order[np.searchsorted(nodes[order], side)] for side in (a, b))
    # The node that more pairs name leads.
    named = np.bincount(np.concatenate((x, y)), minlength=len(nodes))
    lead, partner = np.where(named[x] >= named[y], x, y), np.where(named[x] >= named[y], y, x)
    by_lead = np.argsort(lead, kind="stable")
    found, dense = np.zeros(len(a)), np.zeros(len(term) and term.max() + 1)
    for own in np.split(by_lead, np.flatnonzero(np.diff(lead[by_lead])) + 1):
        h, others = lead[own[0]], partner[own]
        dense[term[end[h] : end[h + 1]]] = weight[end[h] : end[h + 1]]
        size = end[others + 1] - end[others]
        at = np.concatenate([np.arange(end[i], end[i + 1]) for i in others.tolist()])
        both = np.add.reduceat(np.minimum(weight[at], dense[term[at]]), np.cumsum(size) - size)
        found[own] = both / (total[h] + total[others] - both)
        dense[term[end[h] : end[h + 1]]] = 0
    return found


def _likenesses(pairs: DataFrame, texts: DataFrame, text_bytes: int, common) -> DataFrame:
    """Likeness of pairs (a, b); many pairs may have one ``a``, the leading node.

    Pairs are dealt by their leading node, those of one with more than ``MEMBERS`` in several parts. A group gets the
    texts that its pairs name, each once: about ``BLOCK_BYTES``, as groups grow in number with the pairs and
    their texts, of ``text_bytes`` on average.
    """
    # Written, so that a join by a node that leads many pairs can be split.
    many = stage(pairs.groupBy(F.col("a").alias("lead")).agg(F.count("*").alias("n")).where(F.col("n") > MEMBERS), "leads")
    groups = max(4, -(-pairs.count() * text_bytes // BLOCK_BYTES))
    parts = F.coalesce(F.ceil(F.col("n") / MEMBERS), F.lit(1))
    pairs = pairs.join(many, F.col("a") == F.col("lead"), "left").select(
        "a", "b", F.pmod(F.xxhash64("a", F.pmod(F.xxhash64("b"), parts)), F.lit(groups)).alias("block")
    )
    named = pairs.select(F.col("block").alias("of"), F.explode(F.array("a", "b")).alias("node")).distinct()
    held = named.join(texts, "node").select("of", "node", "text")
    return (
        pairs.groupBy("block").cogroup(held.groupBy("of")).applyInArrow(_verify(common), "a long, b long, likeness double")
    )


_BITS = [f"bits{j}" for j in range(BITS)]


_BLOCK = ["task", "bucket", "i", "j", "part", "band", "node", "class", "bands", *_BITS, "text"]


def _link_blocks(common):
    """Links between members of different classes, for all sub-blocks (bucket, i, j) dealt to a task's group."""

    def run(table: pa.Table) -> pa.Table:
        column = {c: table[c].to_numpy() for c in ("bucket", "i", "j", "part", "band", "node", "class")}
        bits = np.stack([table[c].to_numpy() for c in _BITS], 1)
        bands_ = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(table), -1)
        order = np.lexsort((column["j"], column["i"], column["bucket"]))
        new = np.zeros(len(order), bool)
        for c in ("bucket", "i", "j"):
            new[1:] |= np.diff(column[c][order]) != 0
        out = [pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "likeness": pa.array([], pa.float64())})]
        for own in np.split(order, np.flatnonzero(new)):
            i, j, band = (int(column[c][own[0]]) for c in ("i", "j", "band"))
            left, right = own[column["part"][own] == i], own[column["part"][own] == j]
            pairs = []
            for at, x in enumerate(left):
                others = right[at + 1 :] if i == j else right
                differ = np.bitwise_count(np.bitwise_or.reduce(bits[others] ^ bits[x], axis=1))
                earlier = (bands_[others, :band] == bands_[x, :band]).any(1)
                others = others[(differ <= DIFFER) & ~earlier & (column["class"][others] != column["class"][x])]
                pairs.append(np.stack((np.full(len(others), x), others), 1))
            pairs = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
            if len(pairs):
                used, back = np.unique(pairs, return_inverse=True)
                back = back.reshape(-1, 2)
                found = block_likeness(
                    back[:, 0], back[:, 1], np.arange(len(used)), table["text"].take(pa.array(used)), common.value
                )
                hit = found >= THRESHOLD
                a, b = column["node"][pairs[hit, 0]], column["node"][pairs[hit, 1]]
                out.append(pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "likeness": found[hit]}))
        return pa.concat_tables(out)

    return run


def deal(members: DataFrame) -> DataFrame:
    """``part`` of each member of an open bucket, and the ``others`` it is held against.

    Pairs of the largest class, ``top``, need no comparison: its members are held against the rest only.
    ``n`` is the bucket's number of members.
    """
    inner = F.col("class") == F.col("top.class")
    rest = F.ceil((F.col("n") - F.col("top.size")) / MEMBERS).cast("int")
    most = F.ceil(F.col("top.size") / MEMBERS).cast("int")
    number = F.xxhash64("node")
    part = F.when(inner, rest + F.pmod(number, most)).otherwise(F.pmod(number, rest)).cast("int")
    others = F.sequence(F.lit(0), F.when(inner, rest - 1).otherwise(rest + most - 1))
    return members.withColumns({"part": part, "others": others})


def links(sketches: DataFrame, texts: DataFrame, names: DataFrame, common) -> tuple[DataFrame, DataFrame]:
    """Links (a, b, likeness) among the texts that share a bucket, enough to join all that hang together, and
    their classes (node, class).

    ``sketches`` has a row (node, bands, bits) per text, ``texts`` the rows (doc_id, digest,
    text), and ``names`` says which of them (doc_id, digest) stands for a node.
    """
    spark = sketches.sparkSession
    # Two numbers per text and band meet by bucket; the sketch joins the members of open buckets only.
    members = sketches.select("node", F.explode(F.array_distinct("bands")).alias("bucket"))
    # Both aggregates by bucket are written before they are joined with its members, so that AQE can split a large one.
    bucket = members.groupBy("bucket").agg(F.min("node").alias("first"), F.count("*").alias("n"))
    active = stage(members.join(stage(bucket.where("n > 1"), "sizes"), "bucket"), "buckets")
    texts = stage(
        _of_node(texts, names.join(active.select("node").distinct(), "node", "left_semi")).select("node", "text").dropDuplicates(["node"]),
        "candidates",
    )
    # Candidates are dealt to groups of bounded size.
    held, n = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).head()
    blocks = max(4, -(-held // BLOCK_BYTES))
    stars = active.where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    stars = stage(stars, "stars")
    near = stage(_likenesses(stars, texts, -(-held // max(n, 1)), common).where(F.col("likeness") >= THRESHOLD), "links")
    classes = components(near)
    active = active.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    # Two members are the pivot and another, which have been compared.
    sizes = active.where("n > 2").groupBy("bucket", "class").agg(F.count("*").alias("size"))
    several = (
        sizes.groupBy("bucket").agg(F.max(F.struct("size", "class")).alias("top"), F.count("*").alias("classes"))
        .where("classes > 1").select("bucket", "top")
    )
    dealt = deal(active.join(stage(several, "several"), "bucket")).join(sketches, "node")
    dealt = dealt.withColumn("band", (F.array_position("bands", F.col("bucket")) - 1).cast("int"))
    dealt = stage(dealt.drop("top"), "open")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    copies = dealt.agg(F.sum(F.size("others"))).head()[0] or 0
    tasks = max(4 * blocks, parts, -(-copies // (4 * MEMBERS)))
    dealt = dealt.withColumn("other", F.explode("others")).drop("others")
    dealt = dealt.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(tasks)))
    more = dealt.join(texts, "node").select(*_BLOCK).groupBy("task").applyInArrow(
        _link_blocks(common), "a long, b long, likeness double"
    )
    found = stage(near.union(more), "links")
    return found, components(found)


def _of_node(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows (doc_id, digest) that stand for a node, with it."""
    names = names.select("node", F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    return rows.join(names, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id", "_digest")


def near_duplicates(docs: DataFrame, n_bands: int = BANDS, n_rows: int = ROWS) -> DataFrame:
    """``doc_id``, ``class_id`` (least doc_id of its class), ``exact_id``, ``n_copies``: a row per row.

    Texts that are equal, or whose likeness reaches 0.8 directly or through others, are a class;
    null reads as the empty text, and texts without words are in a class with equal texts only.
    Rows of one doc_id with different texts stand apart; the first of them by hash has the doc_id as its
    name, and others, and texts without doc_id, have a negative number, which names a class if no doc_id
    does. Other columns of ``docs`` are not used. An empty table gives an empty result.
    """
    return _classes(docs, n_bands, n_rows).select("doc_id", "class_id", "exact_id", "n_copies")


def _classes(docs: DataFrame, n_bands: int = BANDS, n_rows: int = ROWS) -> DataFrame:
    """As ``near_duplicates``, with the text's ``digest`` and ``least``, the doc_id of the row that stands for the text."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keys, idf, _ = common_shingles(docs)
    common = spark.sparkContext.broadcast((keys, idf))
    signed = docs.select("doc_id", F.md5("text").alias("digest"), "text").mapInArrow(
        _sign(common, n_bands, n_rows), "doc_id long, digest string, total double, bands array<long>, " + ", ".join(f"{c} long" for c in _BITS)
    )
    signed = stage(signed, "signed")
    exact = stage(signed.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies")), "exact")
    # Of several texts with one doc_id only one can have its name.
    shared = exact.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.min("digest").alias("named"), F.count("*").alias("n"))
    shared = stage(shared.where("n > 1").select("_id", "named"), "shared")
    unnamed = F.col("doc_id").isNull() | F.coalesce(F.col("named") != F.col("digest"), F.lit(False))
    number = -F.shiftrightunsigned(F.xxhash64("digest"), 1) - 1
    exact = stage(
        exact.join(shared, F.col("doc_id") == F.col("_id"), "left").select(
            "digest", "doc_id", "n_copies", F.when(unnamed, number).otherwise(F.col("doc_id")).alias("node"), unnamed.alias("unnamed")
        ),
        "nodes",
    )
    sketches = _of_node(signed.where("total > 0"), exact).select("node", "bands", *_BITS).dropDuplicates(["node"])
    texts = docs.select("doc_id", F.md5("text").alias("digest"), "text")
    _, classes = links(stage(sketches, "sketches"), texts, exact, common)
    classes = exact.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    if not exact.where("unnamed").isEmpty():
        # Names go before numbers.
        classes = stage(classes, "classes")
        odd = classes.where("unnamed").select("class").distinct()
        name = classes.join(odd, "class", "left_semi").groupBy("class").agg(
            F.coalesce(F.min(F.when(~F.col("unnamed"), F.col("node"))), F.min("node")).alias("name")
        )
        classes = classes.join(name, "class", "left").withColumn("class", F.coalesce("name", "class"))
    classes = classes.select(
        "digest", F.col("doc_id").alias("least"), F.col("class").alias("class_id"), F.col("node").alias("exact_id"), "n_copies"
    )
    return signed.select("doc_id", "digest").join(classes, "digest")


def keep_one(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of every class of near duplicates one document stays, that of the least doc_id that names a text.

    Rows without doc_id are no exception, and of rows that repeat a doc_id all stay whose texts are no duplicates.
    """
    columns = docs.columns
    gone = (F.col("exact_id") != F.col("class_id")) | ~F.col("doc_id").eqNullSafe(F.col("least"))
    # Written first, so that a join by the digest of many copies can be split.
    marks = (
        stage(_classes(docs), "classed")
        .groupBy("doc_id", "digest")
        .agg(F.max(gone).alias("_gone"), F.count("*").alias("_n"))
        .where("_gone OR _n > 1")
        .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_marked"), "_gone", "_n")
    )
    marks = stage(marks, "marks")
    docs = docs.withColumn("_digest", F.md5(F.coalesce("text", F.lit(""))))
    same = (F.col("_digest") == F.col("_marked")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
    kept = docs.join(marks, same, "left").where("_gone IS NULL OR NOT _gone")
    if marks.where("NOT _gone").isEmpty():
        return kept.select(*columns)
    once = kept.where("_n > 1").dropDuplicates(["doc_id", "_digest"]).select(*columns)
    return kept.where("_n IS NULL").select(*columns).unionByName(once)
