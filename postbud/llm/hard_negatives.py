"""Hard negatives by an inverted multi-index, exact.

Vectors become integers, floor(``SCALE`` * x), and a row's score for an anchor is their inner product.
An anchor's positives are its ``POSITIVES`` best other rows of the same label. For a positive of
score p the window is ``LOW`` * p <= 100 * score <= ``HIGH`` * p, and its negatives are the ``NEGATIVES`` best rows of
other labels within. Higher scores come first, ties by smaller id.

Each half of the dimensions has a codebook, learnt by k-means from a bounded sample (``SAMPLE_ROWS`` rows,
``SAMPLE_VALUES`` numbers at most); a pair of codewords is a cell. All rows are indexed: they are dealt by a hash to shards of
about ``SHARD_ROWS``, and anchors to blocks of about ``BLOCK_ROWS``, so a cell, a label or copies of one vector make no task larger.
One task searches a shard for a block. It holds the shard by cell, with the
radius of every half codeword. An anchor's score of a row in cell (i, j) is at most
q1.c1[i] + |q1| r1[i] + q2.c2[j] + |q2| r2[j], and the multi-sequence heap visits cells in falling order of that sum.
A visit ends when the window is certified: no unvisited cell's bound reaches the last of the best rows found (nor the window's lower end).
So what a shard returns is exact whatever the codebooks; they only decide how much is
read. What shards return is merged by anchor: at most ``POSITIVES``, or ``NEGATIVES`` a window, from each. Windows need the
merged positives, so there are two passes over the shards.

Each anchor meets every shard, as it must where bounds do not part the rows: rows are sent once for each
block of anchors, anchors once for each shard. Nothing but the codebooks reaches the driver or all tasks.

Rows with a null id, label or vector, or with a component that is null or not finite take no part. Vectors of
unequal lengths are compared as if the shorter ones ended in zeros; an empty one scores 0. Repeated
rows count each: a copy of the anchor is another row. Repeated anchors are mined each. p of 0 leaves the
window score = 0, p below 0 none. Scores are exact in float32 or float64 where the norms allow it, in whole numbers
beyond; those outside of a long are cut to plus or minus 2^63 - 1. Empty tables, and anchors without positives or negatives, give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postbud.session import stage

SCALE = 256
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
SAMPLE_ROWS, SAMPLE_VALUES, ROUNDS = 8192, 1 << 21, 6
SHARD_ROWS, BLOCK_ROWS, CELL_ROWS, FIRST_ROWS = 100_000, 20_000, 128, 256
MOST = (1 << 63) - 1
LEAST = -MOST

VECTOR = "row long, id long, label long, vector array<double>"
FOUND = "anchor_row long, anchor_id long, bound long, row long, id long, score long"


# --- codebooks --------------------------------------------------------------------------------


def k_means(points: np.ndarray, k: int) -> np.ndarray:
    """Centres of ``points``; the first ones are spread over them, and empty ones stay where they are."""
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        own = nearest(points, centres)
        count = np.bincount(own, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, own, points)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        away = (centres * centres).sum(1) - 2 * points @ centres.T
    return np.argmin(np.nan_to_num(away, nan=np.inf), 1)


def codebooks(vectors: DataFrame, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Codewords of both halves, from rows drawn by a hash of their number."""
    width = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // max(width, 1)))
    drawn = vectors.orderBy(F.xxhash64("row")).limit(rows).select("vector").toArrow()["vector"]
    sample = _matrix(drawn.combine_chunks(), width)
    k = min(cells, max(len(sample), 1))
    half = width // 2
    if not len(sample):
        return np.zeros((1, half)), np.zeros((1, width - half))
    return k_means(sample[:, :half], k), k_means(sample[:, half:], k)


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows of one matrix, short ones filled with zeros."""
    size = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


# --- search of one shard ----------------------------------------------------------------------


class Shard:
    """Rows by cell, and for every half codeword how far its rows are from it."""

    def __init__(self, rows: pa.Table, books: tuple[np.ndarray, np.ndarray]):
        width = books[0].shape[1] + books[1].shape[1]
        vectors = _matrix(rows["vector"].combine_chunks(), width)
        halves = vectors[:, : books[0].shape[1]], vectors[:, books[0].shape[1] :]
        code = [nearest(x, c) for x, c in zip(halves, books)]
        self.books, self.k = books, len(books[1])
        self.radius = []
        for x, c, own in zip(halves, books, code):
            radius = np.full(len(c), -np.inf)  # a codeword without rows has no bound to speak of
            np.maximum.at(radius, own, np.sqrt(((x - c[own]) ** 2).sum(1)))
            self.radius.append(radius)
        cell = code[0] * self.k + code[1]
        order = np.lexsort((rows["id"].to_numpy(), cell))
        self.vectors, cell = vectors[order], cell[order]
        self.row, self.id, self.label = (rows[c].to_numpy()[order] for c in ("row", "id", "label"))
        ends = np.cumsum(np.bincount(cell, minlength=len(books[0]) * self.k))
        self.ends = np.concatenate(([0], ends)).tolist()
        self.norm = np.sqrt((vectors * vectors).sum(1)).max(initial=0.0)

    def scores_with(self, anchors: np.ndarray):
        """How to score rows with anchors exactly: in floats where no partial sum can lose a unit."""
        norm = np.sqrt((anchors * anchors).sum(1)).max(initial=0.0) * self.norm
        if norm < 1 << 52:
            kind = np.float32 if norm < 1 << 23 else np.float64
            x, q = self.vectors.astype(kind), anchors.astype(kind)
            return lambda which, first, last: (q[which] @ x[first:last].T).astype(np.int64)

        def whole(which, first, last):
            q, x = ([[int(v) for v in r] for r in m] for m in (anchors[which], self.vectors[first:last]))
            return np.array([[min(max(sum(map(int.__mul__, a, b)), LEAST), MOST) for b in x] for a in q], np.int64)

        return whole

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Half-score bounds of both codebooks, a row per anchor, a little wide for rounding."""
        out, at = [], 0
        for c, radius in zip(self.books, self.radius):
            q = anchors[:, at : at + c.shape[1]]
            at += c.shape[1]
            norm = np.sqrt((q * q).sum(1))[:, None]
            reach = norm * (np.sqrt((c * c).sum(1)) + np.where(radius < 0, 0, radius))
            bound = q @ c.T + norm * np.where(radius < 0, 0, radius) + 1e-9 * reach + 0.5
            out.append(np.where(radius < 0, -np.inf, np.nan_to_num(bound, nan=np.inf, posinf=np.inf, neginf=-np.inf)))
        return out[0], out[1]


class CellHeap:
    """Cells of one anchor in falling order of their bound: the multi-sequence over both sorted halves."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.order = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
        self.value = first[self.order[0]].tolist(), second[self.order[1]].tolist()
        self.heap, self.seen = [(-(self.value[0][0] + self.value[1][0]), 0, 0)], [0] * len(first)

    def bound(self) -> float:
        """No cell still to come has a score above this."""
        return -self.heap[0][0] if self.heap else -np.inf

    def pop(self) -> tuple[int, int]:
        _, i, j = heapq.heappop(self.heap)
        a, b = self.value
        # A cell enters once both that come before it, in its row and its column, have left.
        self.seen[i] = j + 1
        if i + 1 < len(a) and self.seen[i + 1] == j:
            heapq.heappush(self.heap, (-(a[i + 1] + b[j]), i + 1, j))
        if j + 1 < len(b) and (i == 0 or self.seen[i - 1] > j + 1):
            heapq.heappush(self.heap, (-(a[i] + b[j + 1]), i, j + 1))
        return self.order[0][i], self.order[1][j]


class Best:
    """The best rows of one anchor so far: ``most`` for each window [low, high] of scores."""

    def __init__(self, windows: list[tuple[int, int]], most: int):
        self.windows, self.most = windows, most
        self.score, self.id, self.at = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = [low for low, _ in windows]
        self.least = min(self.floor, default=MOST)
        self.top = max((high for _, high in windows), default=LEAST)

    def add(self, score: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
        score, ids, at = (np.concatenate(p) for p in ((self.score, score), (self.id, ids), (self.at, at)))
        order = np.lexsort((ids, -score))
        score, ids, at = score[order], ids[order], at[order]
        keep = np.zeros(len(score), bool)
        for i, part in enumerate(self.parts(score)):
            keep[part] = True
            if part.stop - part.start == self.most:
                self.floor[i] = int(score[part.stop - 1])
        self.least = min(self.floor)
        self.score, self.id, self.at = score[keep], ids[keep], at[keep]

    def parts(self, score: np.ndarray | None = None) -> Iterator[slice]:
        """Where the best of each window stand."""
        score = self.score if score is None else score
        rising = score[::-1]
        for low, high in self.windows:
            first = len(score) - int(np.searchsorted(rising, high, "right"))
            last = len(score) - int(np.searchsorted(rising, low, "left"))
            yield slice(first, max(first, min(last, first + self.most)))


def search(shard: Shard, anchors: pa.Table, same: bool, most: int) -> list[Best]:
    """Best rows of each anchor in the shard: of its own label but itself, or of other labels.

    All anchors of a block go forward together, so that a cell is scored with all that visit it at once.
    """
    vectors = _matrix(anchors["vector"].combine_chunks(), shard.vectors.shape[1])
    rows, labels = anchors["row"].to_numpy(), anchors["label"].to_numpy()
    windows = anchors["windows"].to_pylist()
    found = [Best([(w["low"], w["high"]) for w in own], most) for own in windows]
    score = shard.scores_with(vectors)
    first, second = shard.bounds(vectors)
    heaps = [CellHeap(a, b) for a, b in zip(first, second)]
    step, active = FIRST_ROWS, list(range(len(heaps)))
    while active:
        visits: dict[int, list[int]] = {}
        still = []
        for a in active:
            heap, best, n = heaps[a], found[a], 0
            while n < step and heap.heap and heap.bound() >= best.least:
                i, j = heap.pop()
                cell = i * shard.k + j
                size = shard.ends[cell + 1] - shard.ends[cell]
                if size:
                    visits.setdefault(cell, []).append(a)
                    n += size
            if n:
                still.append(a)
        gained: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for cell, of in visits.items():
            begin, end = shard.ends[cell], shard.ends[cell + 1]
            table = score(of, begin, end)
            own = np.array(of)
            fits = (shard.label[begin:end] == labels[own, None]) == same
            fits &= (table >= np.array([found[a].least for a in of])[:, None]) & (table <= np.array([found[a].top for a in of])[:, None])
            if same:
                fits &= shard.row[begin:end] != rows[own, None]
            which, at = np.nonzero(fits)
            cuts = np.searchsorted(which, np.arange(len(of) + 1)).tolist()
            values = table[which, at]
            at += begin
            for x, a in enumerate(of):
                if cuts[x] < cuts[x + 1]:
                    gained.setdefault(a, []).append((values[cuts[x] : cuts[x + 1]], at[cuts[x] : cuts[x + 1]]))
        for a, parts in gained.items():
            at = np.concatenate([p[1] for p in parts])
            found[a].add(np.concatenate([p[0] for p in parts]), shard.id[at], at)
        active, step = still, 2 * step
    return found


def _searched(left: pa.Table, right: pa.Table, books, same: bool, most: int) -> pa.Table:
    columns: dict[str, list[np.ndarray]] = {f.split()[0]: [np.zeros(0, np.int64)] for f in FOUND.split(", ")}
    if left.num_rows and right.num_rows:
        rows, ids = right["row"].to_numpy(), right["id"].to_numpy()
        windows = right["windows"].to_pylist()
        with np.errstate(over="ignore", invalid="ignore"):  # an endless bound only means that a cell is visited
            shard = Shard(left, books)
            found = search(shard, right, same, most)
        for a, best in enumerate(found):
            for w, part in zip(windows[a], best.parts()):
                n = part.stop - part.start
                at = best.at[part]
                values = (np.full(n, rows[a]), np.full(n, ids[a]), np.full(n, w["bound"]), shard.row[at], best.id[part], best.score[part])
                for c, v in zip(columns, values):
                    columns[c].append(v)
    return pa.table({c: pa.array(np.concatenate(v), pa.int64()) for c, v in columns.items()})


# --- the operator -----------------------------------------------------------------------------


def integer_vectors(rows: DataFrame, row_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Rows that take part, numbered, with whole-number vectors."""
    values = F.col(vector).cast("array<double>")
    usable = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    # floor() gives a long; beyond 2^52 a double has no fraction.
    scaled = F.transform(values, lambda x: F.when(F.abs(x) < float(1 << 40), F.floor(x * SCALE).cast("double")).otherwise(x * SCALE))
    return (
        rows.where(F.col(row_id).isNotNull() & F.col(label).isNotNull() & values.isNotNull() & usable)
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.col(row_id).cast("long").alias("id"),
            F.col(label).cast("long").alias("label"),
            scaled.alias("vector"),
        )
    )


def _blocks(n: int, size: int, least: int = 1) -> int:
    return max(-(-n // size), least)


def _best_of(found: DataFrame, most: int) -> DataFrame:
    """The first rows of every anchor and window over all shards, with their ``rank``."""
    order = Window.partitionBy("anchor_row", "bound").orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``row, id, label, vector`` as ``integer_vectors`` gives them; ``is_anchor`` says which are mined for.
    """
    spark = rows.sparkSession
    rows = stage(rows, "vectors")
    n, n_anchors = rows.agg(F.count("*"), F.count_if(is_anchor)).first()
    n_shards = _blocks(n, SHARD_ROWS, 2 * spark.sparkContext.defaultParallelism)
    n_blocks = _blocks(n_anchors, BLOCK_ROWS)
    books = codebooks(rows, int(min(max((n / n_shards / CELL_ROWS) ** 0.5, 2), 32)))

    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard")
    shards = rows.select("*", F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int").alias("shard")).select("*", every_block)
    anchors = stage(rows.where(is_anchor).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int")), "anchors")

    def searched(anchors: DataFrame, same: bool, most: int) -> DataFrame:
        asked = anchors.select("*", every_shard)
        return _best_of(
            shards.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(
                lambda left, right: _searched(left, right, books, same, most), FOUND
            ),
            most,
        )

    def window(bound: Column, low: Column, high: Column) -> Column:
        return F.struct(bound.alias("bound"), low.alias("low"), high.alias("high"))

    open_ = F.array(window(F.lit(0).cast("long"), F.lit(LEAST), F.lit(MOST)))
    positives = stage(searched(anchors.withColumn("windows", open_), True, POSITIVES), "positives")
    # 30 p <= 100 s <= 90 p, for whole numbers s.
    p = F.col("score").cast("decimal(20,0)")
    low, high = F.ceil(p * LOW / 100).cast("long"), F.floor(p * HIGH / 100).cast("long")
    windows = positives.where(F.col("score") >= 0).groupBy(F.col("anchor_row").alias("row")).agg(F.collect_set(window(F.col("score"), low, high)).alias("windows"))
    negatives = searched(anchors.join(windows, "row"), False, NEGATIVES).select("anchor_row", F.col("bound").alias("score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    mined = positives.drop("rank", "bound", "row").join(negatives, ["anchor_row", "score"])
    return mined.select(
        "anchor_id", F.col("id").alias("positive_id"), F.col("rank").cast("int"), "negative_id",
        F.col("score").alias("positive_score"), "negative_score",
    )


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """The query: labels of every seventh id moved by one, anchors every hundredth."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(integer_vectors(embeddings.select("vec_id", "embedding", label.alias("label"))), F.col("id") % 100 == 0)


ORACLE = f"""
WITH whole AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.row <> b.row WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place FROM scored WHERE same
), negative AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positive p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
    AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score
  WHERE p.place <= {POSITIVES}
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE rank <= {NEGATIVES}
"""
