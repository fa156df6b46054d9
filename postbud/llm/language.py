"""Language identification by interpolated Kneser-Ney character models.

One model of order ``ORDER`` per language, learnt from labelled documents whose crc32(doc_id) mod 4
is not 2. Texts are lower-cased and every run of anything but letters is one space. All models share
sorted arrays of n-gram hashes, each with the log probabilities of the languages that have it, so that one look-up
serves all languages. A text gets the language of the lowest cross-entropy per symbol.

Learning takes a bounded sample: of each language, documents drawn by a hash of doc_id so that about
``SAMPLE_CHARS`` characters are expected; whole texts, no prefixes. One in five of these is left out of
counting and calibrates the rejection: a text is rejected if its cross-entropy exceeds the 99.5 %
quantile there by more than ``SLACK`` times the distance from the median to that quantile (at least
one bit), plus an allowance of 4 / sqrt(symbols) for short texts. Texts that are null or have no
letter are ``und`` and rejected. Without any labelled row every text is ``und``, and texts with letters
are accepted with score 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postbud.llm.text import mix, slices
from postbud.session import stage

ORDER = 4
SAMPLE_CHARS = 1_500_000
SLACK = 3.0
EVIDENCE = 50
_SPACE = 0x20
_ROW_BITS = 10
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Of every code point below 0xFFFF, and of 0xFFFF for all others that are letters."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0xFFFF)] + [True]))
    return _letters[0]


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of 16 bits and their rows: letters, and one space for what stands between them."""
    code = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(chars))
    for c in np.unique(code[code >= 0xFFFF]):
        code = np.where(code == c, 0xFFFF if chr(c).isalpha() else _SPACE, code)
    letter = _is_letter()[code]
    before = np.concatenate(([False], letter[:-1] & (row[1:] == row[:-1])))
    keep = letter | before
    return np.where(letter, code, _SPACE)[keep].astype(np.uint64), row[keep]


def grams(symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The ``ORDER`` symbols that end at each position, packed; before a text stand spaces."""
    out = symbol.copy()
    place = np.arange(len(row)) - np.searchsorted(row, row)
    for j in range(1, ORDER):
        earlier = np.concatenate((np.full(j, _SPACE, np.uint64), symbol[:-j]))[: len(symbol)]
        earlier[place < j] = _SPACE
        out |= earlier << np.uint64(16 * j)
    return out


def _suffix(gram: np.ndarray, n: int) -> np.ndarray:
    return gram & np.uint64((1 << (16 * n)) - 1)


def _hash(gram: np.ndarray, n: int) -> np.ndarray:
    return mix(gram + np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64)))


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of what is there, and whether it is."""
    if not len(sorted_):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(sorted_, wanted)
    at[at == len(sorted_)] = 0
    return at, sorted_[at] == wanted


class Models:
    """For each order two tables by hash: n-grams with log2 probabilities, contexts with log2 weights.

    A table holds a language's entry only where the language was seen to have the n-gram or context, so
    its size grows with the n-grams seen and not with n-grams times languages.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counts)
        orders = [_orders(*counts[lang]) for lang in self.languages]
        n_symbols = max(len(np.unique(np.concatenate([o[1][0] for o in orders]))), 1) + 1
        self.unknown = np.log2(1 / n_symbols)
        self.gram, self.context = {}, {}
        lower = [(np.zeros(1, np.uint64), np.full(1, 1 / n_symbols))] * len(orders)
        for n in range(1, ORDER + 1):
            probs, weights = [], []
            for i, own in enumerate(orders):
                keys, count = own[n]
                contexts, in_context, kinds = np.unique(keys >> np.uint64(16), return_inverse=True, return_counts=True)
                discount = _discount(count)
                total = np.bincount(in_context, count, minlength=len(contexts))
                weight = discount * kinds / total
                # What an n-gram ends in has been seen as well.
                shorter, below = lower[i]
                at = np.searchsorted(shorter, _suffix(keys, n - 1) if n > 1 else np.zeros(len(keys), np.uint64))
                prob = (count - discount) / total[in_context] + weight[in_context] * below[at]
                probs.append((_hash(keys, n), np.log2(prob)))
                weights.append((_hash(contexts, -n), np.log2(weight)))
                lower[i] = keys, prob
            self.gram[n], self.context[n] = _Table(probs), _Table(weights)

    def log_probability(self, gram: np.ndarray) -> np.ndarray:
        """log2 P(last symbol | symbols before) for packed n-grams, a column per language."""
        out = np.zeros((len(gram), len(self.languages)), np.float64)
        left = np.ones(out.shape, bool)
        for n in range(ORDER, 0, -1):
            part = _suffix(gram, n)
            row, lang, value = self.gram[n].entries(_hash(part, n))
            new = left[row, lang]
            row, lang = row[new], lang[new]
            out[row, lang] += value[new]
            left[row, lang] = False
            row, lang, value = self.context[n].entries(_hash(part >> np.uint64(16), -n))
            out[row, lang] += np.where(left[row, lang], value, 0.0)
        out[left] += self.unknown
        return out


class _Table:
    """Sorted hashes; the entries of a hash, a language and its value each, lie next to each other."""

    def __init__(self, by_language: list[tuple[np.ndarray, np.ndarray]]):
        hashes = np.concatenate([h for h, _ in by_language])
        order = np.argsort(hashes, kind="stable")
        self.keys, start = np.unique(hashes[order], return_index=True)
        self.start = np.append(start, len(order))
        kind = np.uint8 if len(by_language) <= 1 << 8 else np.int32
        self.language = np.repeat(np.arange(len(by_language), dtype=kind), [len(h) for h, _ in by_language])[order]
        self.value = np.concatenate([v for _, v in by_language])[order]

    def entries(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``wanted`` that are there, with language and value, a row for each entry."""
        at, hit = _find(self.keys, wanted)
        row = np.flatnonzero(hit)
        first, n = self.start[at[row]], self.start[at[row] + 1] - self.start[at[row]]
        place = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        return np.repeat(row, n), self.language[place], self.value[place]


def _orders(gram: np.ndarray, count: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Counts of the highest order; below, the number of different symbols seen before an n-gram."""
    out = {ORDER: (gram, count.astype(float))}
    for n in range(ORDER - 1, 0, -1):
        keys, kinds = np.unique(_suffix(out[n + 1][0], n), return_counts=True)
        out[n] = keys, kinds.astype(float)
    return out


def _discount(count: np.ndarray) -> float:
    once, twice = (count == 1).sum(), (count == 2).sum()
    return once / (once + 2 * twice) if once and twice else 0.5


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch["lang"].to_pylist()
        for first, data, offsets in slices(batch["text"], lower=True):
            symbol, row = symbols(data, offsets)
            gram = grams(symbol, row)
            here = langs[first : first + len(offsets) - 1]
            for lang in sorted(set(here)):
                own = np.array([x == lang for x in here])[row] if len(row) else np.zeros(0, bool)
                keys, count = np.unique(gram[own], return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(keys), pa.string()), "gram": keys.view(np.int64), "n": count}
                )


def training_rows() -> Column:
    """Rows a model may learn from."""
    return (F.crc32(F.col("doc_id").cast("string")) % 4 != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()


def fit(docs: DataFrame, sample_chars: int = SAMPLE_CHARS) -> tuple[Models | None, dict[str, float]]:
    """The models and, by language, the cross-entropy up to which a text is accepted."""
    labelled = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(training_rows())
    # Written, so that its size is known and Spark broadcasts it only while it is small.
    total = stage(labelled.groupBy("lang").agg(F.sum(F.length("text")).alias("_chars")), "lengths")
    # The draw is a hash of doc_id; a language's share of rows makes the expected sample bounded.
    unit = F.conv(F.substring(F.md5(F.concat(F.lit("lang:"), F.col("doc_id").cast("string"))), 1, 8), 16, 10)
    drawn = labelled.join(total, "lang").where(
        unit.cast("double") / float(1 << 32) < sample_chars / F.greatest("_chars", F.lit(1))
    )
    drawn = stage(drawn.select("doc_id", "text", "lang"), "labelled")
    apart = F.crc32(F.concat(F.lit("hold:"), F.col("doc_id").cast("string"))) % 5 == 0
    counted = (
        drawn.where(~apart).select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).orderBy("lang", "gram").toPandas()
    )
    counts = {}
    for lang, rows in counted.groupby("lang"):
        gram = rows["gram"].to_numpy().view(np.uint64)
        order = np.argsort(gram)
        counts[lang] = gram[order], rows["n"].to_numpy()[order]
    if not counts:
        return None, {}
    models = Models(counts)
    scored = drawn.where(apart).select("doc_id", "text", "lang").mapInArrow(
        _score(drawn.sparkSession.sparkContext.broadcast((models, {}))), _SCORED
    )
    spread = (
        scored.join(drawn.select("doc_id", "lang"), "doc_id").where("lang = lang_pred").groupBy("lang")
        .agg(F.percentile_approx("cross_entropy", [0.5, 0.995], 10_000).alias("q"))
    )
    limits = {r["lang"]: r["q"][1] + max(SLACK * (r["q"][1] - r["q"][0]), 1.0) for r in spread.collect()}
    return models, limits


_SCORED = "doc_id long, lang_pred string, score double, cross_entropy double, accepted boolean"


def _score(state):
    """Predictions, from the text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, limits = state.value
        for batch in batches:
            for first, data, offsets in slices(batch["text"], lower=True):
                n = len(offsets) - 1
                symbol, row = symbols(data, offsets)
                size = np.bincount(row, minlength=n)
                has_letter = np.bincount(row[symbol != _SPACE], minlength=n) > 0
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, n), *_predict(models, limits, symbol, row, size, has_letter)],
                    ["doc_id", "lang_pred", "score", "cross_entropy", "accepted"],
                )

    return run


def _predict(models, limits, symbol, row, size, has_letter) -> list[pa.Array]:
    n = len(size)
    if models is None:
        return [pa.array(["und"] * n, pa.string()), pa.array(np.zeros(n)), pa.array([None] * n, pa.float64()), pa.array(has_letter)]
    # Equal n-grams are looked up once per slice of texts.
    keys, back = np.unique(grams(symbol, row), return_inverse=True)
    log_p = models.log_probability(keys)
    entropy = np.stack([-np.bincount(row, log_p[back, i], minlength=n) for i in range(log_p.shape[1])], 1)
    entropy /= np.maximum(size, 1)[:, None]
    best = entropy.argmin(1)
    low = entropy[np.arange(n), best]
    score = 1 / np.exp2(-(entropy - low[:, None]) * np.minimum(size, EVIDENCE)[:, None]).sum(1)
    limit = np.array([limits.get(x, np.inf) for x in models.languages])[best] + 4 / np.sqrt(np.maximum(size, 1))
    names = np.array(models.languages, object)[best]
    return [
        pa.array(np.where(has_letter, names, "und"), pa.string()),
        pa.array(np.where(has_letter, score, 0.0)),
        pa.array(low, mask=~has_letter),
        pa.array(has_letter & (low <= limit)),
    ]


def _scored(docs: DataFrame) -> tuple[DataFrame, object]:
    state = docs.sparkSession.sparkContext.broadcast(fit(docs))
    return docs, state


def identify(docs: DataFrame) -> DataFrame:
    """A row per document: held_out, lang_pred, score, cross_entropy, accepted."""
    docs, state = _scored(docs)
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_score(state), _SCORED)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted")


def keep_accepted(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language is recognised; rows and columns stay as they are."""
    docs, state = _scored(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _score(state)
        for batch in batches:
            doc_id = pa.array(np.arange(batch.num_rows), pa.int64())
            texts = pa.RecordBatch.from_arrays([doc_id, batch["text"]], ["doc_id", "text"])
            accepted = pa.concat_arrays([pa.array([], pa.bool_()), *(b["accepted"] for b in score(iter([texts])))])
            yield batch.filter(accepted)

    return docs.mapInArrow(run, docs.schema)
