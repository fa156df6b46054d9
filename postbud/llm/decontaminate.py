"""Documents that hold benchmark items, verbatim or paraphrased, by latent semantic retrieval.

Words are runs of ASCII letters, digits and all non-ASCII characters, lower-cased. Texts are cut into steps of
``STEP`` words, and two steps in a row are a passage; items are cut alike, or are one passage if shorter.
Terms are the benchmark's words, weighted by idf over all documents. Terms in more than ``COMMON`` of all
documents have no weight, except the ``LEAST_TERMS`` rarest of each item.

1. One pass counts document frequencies of the terms over all documents and takes a randomised sketch of the
   passage-term matrix A = C W (counts, weights): every task adds up its part of C'(C G) for a random G of
   ``RANK`` columns, and parts are summed in a tree. The rows of G are scaled by the terms' rarity among
   the items, as the weights are known only after the pass; they are applied to the sum. The benchmark's own
   passages are scaled to hold half of it. An orthonormal basis of the sketch spans the leading singular vectors.
2. One pass projects every passage and compares it with every item passage. Candidates have a cosine of ``COSINE``
   or more and hold at least ``MASS`` of the item passage's length in its direction. A short item has a low cosine
   with a passage of 48 words, so an index of the items' rarest words adds every passage the cosine misses: to
   find m of n words in order, a text needs one of any n - m + 1 of them, and as many of all as counted in its steps.
   Items of fewer than eight words are looked up as runs of words. So no hit depends on cosine, rank or number of items.
   A candidate counts if the longest common subsequence of words covers ``VERBATIM`` of the
   item, or ``PARAPHRASE`` of it and ``ANSWER`` of the item's answer (its last sentence of three words or
   more). Items of fewer than eight words must stand there word for word.

No document text is shuffled and nothing about single documents comes to the driver. The benchmark is taken in blocks of
``BLOCK`` items, so what is broadcast has a bound; an item is expected to be a text of ordinary length.
Null texts and texts without words hold nothing; items without words are held by nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postbud.llm.text import PUNCTUATION, mix, prefix_hash, slices, span_hash, words
from postbud.session import stage

STEP = 24
COMMON = 0.05
LEAST_TERMS = 8
RANK = 64
COSINE = 0.4
MASS = 0.4
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.6, 0.9
SHORT = 8
BLOCK = 20_000
SEED = 9
_SLOT_BITS = 20
#: Terms share this many columns when the words of steps are counted; passages counted at a time.
_COLUMNS = 2048
_PART = 4096


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, row = words(data, offsets, PUNCTUATION)
    return span_hash(prefix_hash(data), start, end), row


def _hashes(text: str) -> np.ndarray:
    found = [word_hashes(data, offsets)[0] for _, data, offsets in slices(pa.array([text]), lower=True)]
    return found[0]


class Benchmark:
    """Items of a block: their words, terms, weights and passages."""

    def __init__(self, item_ids: list, texts: list[str]):
        self.item_ids = item_ids
        self.words = [_hashes(t) for t in texts]
        self.answers = [_answer(t) for t in texts]
        self.terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.words]))
        # First term by the top bits of its hash; terms of equal bits follow one another.
        self.first = np.searchsorted(self.terms, np.arange((1 << _SLOT_BITS) + 1).astype(np.uint64) << np.uint64(64 - _SLOT_BITS))
        self.first[-1] = len(self.terms)
        self.deepest = int(np.diff(self.first).max()) if len(self.terms) else 0
        self.basis = self.queries = self.query_item = self.index = None
        self.mass = np.zeros(0)
        self.sets = [frozenset(w.tolist()) for w in self.words]
        self.lists = [w.tolist() for w in self.words]
        # Until document frequencies are known, rarity among the items stands in.
        df = np.bincount(self.term_of(np.concatenate([np.zeros(0, np.uint64), *map(np.unique, self.words)])), minlength=len(self.terms))
        self.weigh(df, len(texts))

    def term_of(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for other words."""
        slot = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        out = np.full(len(hashes), -1, np.int32)
        left = np.flatnonzero(self.first[slot] < self.first[slot + 1])
        for depth in range(self.deepest):
            at = self.first[slot[left]] + depth
            left, at = left[at < self.first[slot[left] + 1]], at[at < self.first[slot[left] + 1]]
            hit = self.terms[at] == hashes[left]
            out[left[hit]] = at[hit]
            left = left[~hit]
        return out

    def weigh(self, df: np.ndarray, n: int) -> None:
        self.df = df
        idf = np.log((n + 1) / (df + 1)).astype(np.float32) + np.float32(1e-3)
        keep = df <= COMMON * n
        for own in self.words:
            t = np.unique(self.term_of(own))
            keep[t[np.argsort(df[t], kind="stable")[:LEAST_TERMS]]] = True
        self.weight = np.where(keep, idf, 0).astype(np.float32)

    def passages(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Item passages projected by a terms x rank matrix, scaled to length 1, and their items."""
        out, item = [], []
        for i, own in enumerate(self.words):
            term = self.term_of(own)
            for at in range(0, max(len(term) - STEP, 1), STEP):
                part = term[at : at + 2 * STEP]
                if len(part):
                    out.append((self.weight[part, None] * of[part]).sum(0))
                    item.append(i)
        found = np.array(out, np.float32).reshape(-1, of.shape[1])
        return found, np.array(item, np.int64)

    def set_index(self) -> None:
        """Terms one of which every passage that holds an item must hold, and runs of words of short items."""
        self.runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.numbers = [self.term_of(own) for own in self.words]
        self.answer_numbers = [self.term_of(own) for own in self.answers]
        # Steps that the region of a passage reaches to either side, as 0, 1, 3, 7, ...
        self.reach = np.array([(1 << (-(-len(own) // STEP)).bit_length()) - 1 for own in self.words], np.int64)
        for n in {len(own) for own in self.words if 0 < len(own) < SHORT}:
            item = np.array([i for i, own in enumerate(self.words) if len(own) == n])
            run = np.array([_runs(self.words[i], n)[0] for i in item], np.uint64)
            order = np.argsort(run, kind="stable")
            self.runs[n] = run[order], item[order]
        term, item = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, own in enumerate(self.numbers):
            if len(own) < SHORT:
                continue
            some = min(self._needed(own, PARAPHRASE), self._needed(self.answer_numbers[i], ANSWER), key=lambda t: self.df[t].sum())
            found = np.union1d(self._needed(own, VERBATIM), some)
            term.append(found)
            item.append(np.full(len(found), i))
        term, item = np.concatenate(term), np.concatenate(item)
        order = np.argsort(term, kind="stable")
        self.index = np.searchsorted(term[order], np.arange(len(self.terms) + 1)), item[order]

    def _needed(self, term: np.ndarray, share: float) -> np.ndarray:
        """The rarest terms of which one must be there if ``share`` of all are."""
        most_lost = len(term) - math.ceil(share * len(term) - 1e-6)
        return np.unique(term[np.argsort(self.df[term], kind="stable")[: most_lost + 1]])

    def cosine(self, item: int, passage: np.ndarray) -> float:
        """Of a projected passage with the nearest passage of an item, 0 if either has no weight."""
        own = self.queries[np.searchsorted(self.query_item, item) : np.searchsorted(self.query_item, item, "right")]
        length = np.sqrt((passage**2).sum())
        return float((own @ passage).max() / length) if len(own) and length > 0 else 0.0

    def set_queries(self) -> None:
        made, item = self.passages(self.basis)
        length = np.sqrt((made**2).sum(1))
        self.queries = made[length > 0] / length[length > 0, None]
        self.query_item, self.mass = item[length > 0], length[length > 0]


def _runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    out = np.zeros(max(len(hashes) - n + 1, 0), np.uint64)
    for j in range(n):
        out = mix(out + hashes[j : j + len(out)] * np.uint64(2 * j + 0x51ED270B))
    return out


def _answer(text: str) -> np.ndarray:
    sentences = [h for h in map(_hashes, re.split(r"[.!?\n]+", text)) if len(h)]
    long = [h for h in sentences if len(h) >= 3]
    return (long or sentences or [np.zeros(0, np.uint64)])[-1]


class _Steps:
    """Weighted terms of a slice of texts, by step."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, bench: Benchmark):
        self.hashes, row = word_hashes(data, offsets)
        n_words = np.bincount(row, minlength=len(offsets) - 1)
        self.first_word = np.cumsum(n_words) - n_words
        self.n_words = n_words
        n_steps = -(-n_words // STEP)
        first_step = np.cumsum(n_steps) - n_steps
        self.row = np.repeat(np.arange(len(n_words)), n_steps)
        self.place = np.arange(len(self.row)) - first_step[self.row]
        term = bench.term_of(self.hashes)
        at = np.flatnonzero(term >= 0)
        self.all_terms, self.all_rows = term[at], row[at]
        self.all_steps = first_step[row[at]] + (at - self.first_word[row[at]]) // STEP
        self.word_row = row
        at = at[bench.weight[term[at]] > 0]
        self.term = term[at]
        self.step = first_step[row[at]] + (at - self.first_word[row[at]]) // STEP
        self.weight = bench.weight[self.term]

    def document_frequency(self, terms: int) -> np.ndarray:
        if len(self.n_words) * terms <= 1 << 24:
            seen = np.zeros((len(self.n_words), terms), bool)
            seen[self.all_rows, self.all_terms] = True
            return seen.sum(0)
        key = np.unique(self.all_rows.astype(np.int64) * terms + self.all_terms)
        return np.bincount(key % terms, minlength=terms)

    def project(self, of: np.ndarray, weighted: bool = True) -> np.ndarray:
        """Passages (a step and the next of its text) projected by a terms x rank matrix."""
        out = np.zeros((len(self.row) + 1, of.shape[1]), np.float32)
        rows = of[self.term]
        if weighted:
            rows *= self.weight[:, None]
        if len(self.step):
            _add_rows(out, self.step, rows)
        joined = out[:-1].copy()
        follows = np.flatnonzero(self.row[1:] == self.row[:-1])
        joined[follows] += out[follows + 1]
        return joined


def _add_rows(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """out[at] += rows where ``at`` is sorted and may repeat: first rows of each place, then second ones, and so on."""
    start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    size = np.diff(np.append(start, len(at)))
    while len(start):
        out[at[start]] += rows[start]
        size -= 1
        start = start[size > 0] + 1
        size = size[size > 0]


def _sketch(bench, rank: int):
    """Document frequencies of the terms and the task's part of the sketch, in one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bench.value
        random = _random(len(b.terms), rank) * b.weight[:, None]
        total, df = np.zeros((len(b.terms), rank), np.float32), np.zeros(len(b.terms), np.int64)
        n = 0
        for batch in batches:
            n += batch.num_rows
            for _, data, offsets in slices(batch["text"], lower=True):
                steps = _Steps(data, offsets, b)
                df += steps.document_frequency(len(b.terms))
                if not len(steps.term):
                    continue
                made = steps.project(random, weighted=False)
                # A step belongs to its own passage and to the one before.
                both = made.copy()
                follows = np.flatnonzero(steps.row[1:] == steps.row[:-1])
                both[follows + 1] += made[follows]
                order = np.argsort(steps.term, kind="stable")
                _add_rows(total, steps.term[order], both[steps.step[order]])
        yield _sum_row(total, df, n)

    return run


def _random(n: int, rank: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((n, rank), np.float32)


_SUMS = "part binary, df binary, n long"


def _sum_row(total: np.ndarray, df: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([total.tobytes()], pa.binary()), pa.array([df.tobytes()], pa.binary()), pa.array([n], pa.int64())],
        ["part", "df", "n"],
    )


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, df, n = None, None, 0
    for batch in batches:
        for row in batch.to_pylist():
            part, count = np.frombuffer(row["part"], np.float32), np.frombuffer(row["df"], np.int64)
            total, df = (part, count) if total is None else (total + part, df + count)
            n += row["n"]
    if total is not None:
        yield _sum_row(total, df, n)


def decompose(docs: DataFrame, bench: Benchmark, rank: int) -> None:
    """Weigh the terms and set the basis (terms x rank) of the leading right singular vectors, in one pass."""
    spark = docs.sparkSession
    # A task writes a matrix whatever it reads, so there are no more tasks than keep the cluster busy.
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    read = docs.select("text").coalesce(tasks)
    sums = stage(read.mapInArrow(_sketch(spark.sparkContext.broadcast(bench), rank), _SUMS), "sketch")
    while (parts := sums.rdd.getNumPartitions()) > 8:
        sums = stage(sums.coalesce(-(-parts // 8)).mapInArrow(_add, _SUMS), "sketch")
    row = sums.coalesce(1).mapInArrow(_add, _SUMS).head()
    random = _random(len(bench.terms), rank) * bench.weight[:, None]
    total, own = np.zeros((len(bench.terms), rank)), np.zeros((len(bench.terms), rank))
    if row is not None:
        total += np.frombuffer(row["part"], np.float32).reshape(-1, rank)
        bench.weigh(np.frombuffer(row["df"], np.int64), row["n"])
    for words_ in bench.words:
        term, count = np.unique(bench.term_of(words_), return_counts=True)
        own[term] += count[:, None] * (count @ random[term])
    total, own = total * bench.weight[:, None], own * bench.weight[:, None]
    if np.any(total) and np.any(own):
        own *= np.linalg.norm(total) / np.linalg.norm(own)
    basis, _ = np.linalg.qr(total + own)
    bench.basis = basis.astype(np.float32)


def subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a machine word (or long integer) at a time."""
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    every = (1 << len(a)) - 1
    state = every
    for x in b.tolist():
        hit = state & where.get(x, 0)
        state = ((state + hit) | (state - hit)) & every
    return len(a) - state.bit_count()


def verify(item: np.ndarray, answer: np.ndarray, region: np.ndarray) -> tuple[float, float] | None:
    """Shares of the item and of its answer found in order in the region, if they make it a hit."""
    n = len(item)
    if n < SHORT:
        found = any(np.array_equal(region[i : i + n], item) for i in np.flatnonzero(region == item[0]))
        return (1.0, 1.0) if found else None
    share = subsequence(item, region) / n
    if share < PARAPHRASE:
        return None
    answered = subsequence(answer, region) / len(answer)
    return (share, answered) if share >= VERBATIM or answered >= ANSWER else None


def _indexed(b: Benchmark, steps: _Steps) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Passages and items of ``SHORT`` words or more such that the passage's steps may hold enough words of the item."""
    first, items = b.index
    size = first[steps.all_terms + 1] - first[steps.all_terms]
    at = np.flatnonzero(size)
    if not len(at):
        return
    # A bounded number of pairs at a time.
    for part in np.split(at, np.flatnonzero(np.diff(np.cumsum(size[at]) * (2 * int(b.reach.max()) + 2) >> 20)) + 1):
        n = size[part]
        item = items[np.repeat(first[steps.all_terms[part]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        pair = np.unique(np.repeat(steps.all_steps[part], n) * len(b.words) + item)
        step, item = pair // len(b.words), pair % len(b.words)
        reach = b.reach[item]
        for own in np.unique(reach).tolist():
            # The passages whose region may hold the step, in its own text.
            s, i = step[reach == own], item[reach == own]
            passage = (s[:, None] + np.arange(-own - 1, own + 1)).ravel()
            item_of, step_of = np.repeat(i, 2 * own + 2), np.repeat(s, 2 * own + 2)
            inside = (passage >= 0) & (passage < len(steps.row))
            passage, item_of, step_of = passage[inside], item_of[inside], step_of[inside]
            pairs = np.unique((passage * len(b.words) + item_of)[steps.row[passage] == steps.row[step_of]])
            yield from _counted(b, steps, pairs // len(b.words), pairs % len(b.words), own)


def _counted(b: Benchmark, steps: _Steps, passage: np.ndarray, item: np.ndarray, reach: int):
    """Those of the pairs (by passage) whose words, in any order, would be enough for a hit."""
    start = 0
    while start < len(passage):
        low = int(passage[start])
        end = int(np.searchsorted(passage, low + _PART))
        lead = max(low - reach, 0)
        held = _held(steps, lead, min(int(passage[end - 1]) + reach + 2, len(steps.row)), reach)
        for at in range(start, end, 1 << 15):
            p, i = passage[at : min(at + (1 << 15), end)], item[at : min(at + (1 << 15), end)]
            there = _share(held, p - lead, i, b.numbers)
            stay = there >= PARAPHRASE - 1e-6
            p, i, there = p[stay], i[stay], there[stay]
            if len(p):
                stay = (there >= VERBATIM - 1e-6) | (_share(held, p - lead, i, b.answer_numbers) >= ANSWER - 1e-6)
                yield p[stay], i[stay]
        start = end


def _held(steps: _Steps, low: int, high: int, reach: int) -> np.ndarray:
    """Which columns of terms the steps from ``reach`` before to ``reach + 1`` after each step hold."""
    held = np.zeros((high - low + 2 * reach + 1, _COLUMNS), bool)
    at = slice(*np.searchsorted(steps.all_steps, [low, high]))
    held[steps.all_steps[at] - low + reach, steps.all_terms[at] % _COLUMNS] = True
    width = 1
    while width < 2 * reach + 2:  # a power of two
        held[:-width] |= held[width:].copy()
        width *= 2
    return held[: high - low]


def _share(held: np.ndarray, row: np.ndarray, item: np.ndarray, numbers: list[np.ndarray]) -> np.ndarray:
    own, which = np.unique(item, return_inverse=True)
    size = np.array([len(numbers[i]) for i in own.tolist()], np.int64)
    flat, first = np.concatenate([numbers[i] for i in own.tolist()]) % _COLUMNS, np.cumsum(size) - size
    n = size[which]
    begin = np.cumsum(n) - n
    column = flat[np.repeat(first[which] - begin, n) + np.arange(n.sum())]
    return np.add.reduceat(held[np.repeat(row, n), column], begin, dtype=np.int64) / n


def _search_slice(b: Benchmark, data: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], tuple]:
    """Hits of a slice: (row, item) to (cosine, share of the item, share of the answer)."""
    steps = _Steps(data, offsets, b)
    hits: dict[tuple[int, int], tuple] = {}
    if not len(steps.all_terms):
        return hits
    made = steps.project(b.basis)
    for n, (run, item) in b.runs.items():
        found = _runs(steps.hashes, n)
        low, high = np.searchsorted(run, found), np.searchsorted(run, found, "right")
        at = np.flatnonzero(low < high)
        at = at[steps.word_row[at] == steps.word_row[at + n - 1]]
        for w in at.tolist():
            row = int(steps.word_row[w])
            passage = int(np.searchsorted(steps.row, row)) + (w - int(steps.first_word[row])) // STEP
            for q in item[low[w] : high[w]].tolist():
                if (row, q) not in hits:
                    hits[row, q] = (b.cosine(q, made[passage]), 1.0, 1.0)

    def check(passage: int, q: int) -> None:
        key = int(steps.row[passage]), q
        if key in hits and hits[key][1] == 1.0:
            return
        item, first, n = b.words[q], steps.first_word[steps.row[passage]], steps.n_words[steps.row[passage]]
        start = max(int(steps.place[passage]) * STEP - len(item), 0)
        end = min((int(steps.place[passage]) + 2) * STEP + len(item), int(n))
        region = steps.hashes[first + start : first + end]
        held = b.sets[q].intersection(region.tolist())
        if sum(map(held.__contains__, b.lists[q])) < PARAPHRASE * len(item):
            return
        found = verify(item, b.answers[q], region)
        if found and (key not in hits or found > hits[key][1:]):
            hits[key] = (b.cosine(q, made[passage]), *found)

    length = np.sqrt((made**2).sum(1))
    some = np.flatnonzero(length > 0) if len(b.queries) else np.zeros(0, np.int64)
    for at in range(0, len(some), 8192):
        part = some[at : at + 8192]
        along = made[part] @ b.queries.T
        cosine = along / length[part, None]
        near, query = np.nonzero((cosine >= COSINE) & (along >= MASS * b.mass))
        for p, q in zip(part[near].tolist(), b.query_item[query].tolist()):
            check(p, q)
    for passages, items in _indexed(b, steps):
        for p, q in zip(passages.tolist(), items.tolist()):
            check(p, q)
    return hits


_PAIRS = "doc_id long, item_id long, cosine double, item_share double, answer_share double"


def _search(bench):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bench.value
        for batch in batches:
            ids, out = batch["doc_id"], []
            for first, data, offsets in slices(batch["text"], lower=True):
                for (row, item), found in _search_slice(b, data, offsets).items():
                    out.append((ids[first + row].as_py(), b.item_ids[item], *found))
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _PAIRS.replace(",", "").split()[::2])

    return run


def prepare(docs: DataFrame, items: pd.DataFrame, rank: int = RANK) -> Benchmark | None:
    """Everything a task needs to search for a block of items; None if no item has a word."""
    bench = Benchmark(items["item_id"].tolist(), items["text"].fillna("").tolist())
    if not len(bench.terms):
        return None
    decompose(docs, bench, min(rank, len(bench.terms)))
    bench.set_queries()
    bench.set_index()
    return bench


def blocks(benchmark: DataFrame) -> Iterator[pd.DataFrame]:
    """The items, ``BLOCK`` at a time."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").dropDuplicates().orderBy("item_id", "text")
    waiting = []
    for row in rows.toLocalIterator():
        waiting.append(row)
        if len(waiting) == BLOCK:
            yield pd.DataFrame(waiting, columns=["item_id", "text"])
            waiting = []
    if waiting:
        yield pd.DataFrame(waiting, columns=["item_id", "text"])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, cosine and shares: one row per document and item it holds."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    found = spark.createDataFrame([], _PAIRS)
    for items in blocks(benchmark):
        bench = prepare(docs, items)
        if bench is not None:
            found = found.union(docs.mapInArrow(_search(spark.sparkContext.broadcast(bench)), _PAIRS))
    best = F.max(F.struct("item_share", "answer_share", "cosine")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.cosine", "best.item_share", "best.answer_share"
    )


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold no item of ``benchmark``; rows and columns stay as they are."""
    out = docs
    for items in blocks(spark.read.parquet(f"{sf_dir}/benchmark.parquet")):
        bench = prepare(docs, items)
        if bench is not None:
            out = out.mapInArrow(_clean(spark.sparkContext.broadcast(bench)), docs.schema)
    return out


def _clean(bench):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = np.ones(batch.num_rows, bool)
            for first, data, offsets in slices(batch["text"], lower=True):
                for row, _ in _search_slice(bench.value, data, offsets):
                    stay[first + row] = False
            yield batch.filter(pa.array(stay))

    return run
