"""Token counts by rank-synchronous merging of ragged arrays.

The vocabulary file (byte-level BPE, format of the tokenizers library) is a parameter and is read in
every worker. Texts are cut by the file's pre-tokenisation; distinct pre-tokens of a slice of
texts are held as one ragged array of symbols. In a round each sequence applies its own pair of
lowest rank, at all its places from left to right, all sequences at once; sequences without such a pair
are done and leave. (A piece of more than ``LONG`` bytes goes through a queue of its own, as it would
take many rounds; the merges are the same.) What is left of a sequence is its number of tokens. Counts of pre-tokens are kept from
slice to slice, up to ``KNOWN`` of them.

Special strings in a text become one token each, as is the library's default, so a text is split
at them first. Null reads as the empty text, which has no tokens.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1024
KNOWN = 400_000
LONG = 2000
SLOT_BITS = 19
_SPREAD, _MASK, _SHIFT = np.int64(0x1E3779B97F4A7C15), np.int64((1 << 63) - 1), np.int64(63 - SLOT_BITS)
SLICE_CHARS = 1 << 20
#: Fixed values of the byte-level format: the split pattern, and the bytes that stand for themselves.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Spaces beside other white space.
SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
UNEVEN = ["  ", *[f" {x}" for x in SPACES], *[f"{x} " for x in SPACES]]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class RankMerger:
    """Counts tokens of texts under one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        split, model = file["pre_tokenizer"], file["model"]
        if split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or file["normalizer"]:
            raise ValueError("only plain byte-level vocabularies are supported")
        if model["type"] != "BPE" or model["ignore_merges"]:
            raise ValueError("only BPE models that apply merges are supported")
        vocab = model["vocab"]
        # Bytes that are not printable are written as the code points from 256 on, in order.
        others = iter(range(256, 512))
        char = [chr(b) if b in PRINTABLE else chr(next(others)) for b in range(256)]
        self.byte = np.array([vocab[c] for c in char], np.int64)
        self.size = max(vocab.values()) + 1
        left = np.array([vocab[a] for a, _ in model["merges"]], np.int64)
        right = np.array([vocab[b] for _, b in model["merges"]], np.int64)
        made = np.array([vocab[a + b] for a, b in model["merges"]], np.int64)
        # Where a pair is listed again the first rank holds.
        pair, rank = np.unique(left * self.size + right, return_index=True)
        self.none, self.made = len(made), made
        self.rank_of = dict(zip(pair.tolist(), rank.tolist()))
        # Pairs by hash; where a slot is taken the next free one holds.
        self.slot_pair = np.full(1 << SLOT_BITS, -1, np.int64)
        self.slot_rank = np.full(1 << SLOT_BITS, self.none, np.int32)
        for p, r in self.rank_of.items():
            slot = ((p * int(_SPREAD)) % (1 << 63)) >> int(_SHIFT)
            while self.slot_pair[slot] >= 0:
                slot = (slot + 1) % (1 << SLOT_BITS)
            self.slot_pair[slot], self.slot_rank[slot] = p, r
        special = [t["content"] for t in file["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.split = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or ``self.none``."""
        pair = left * self.size + right
        slot = ((pair * _SPREAD) & _MASK) >> _SHIFT
        rank = np.where(self.slot_pair[slot] == pair, self.slot_rank[slot], self.none)
        open_ = np.flatnonzero((self.slot_pair[slot] != pair) & (self.slot_pair[slot] >= 0))
        while len(open_):  # the slot holds another pair: try the next one
            slot[open_] = (slot[open_] + 1) % len(self.slot_pair)
            held = self.slot_pair[slot[open_]]
            hit = open_[held == pair[open_]]
            rank[hit] = self.slot_rank[slot[hit]]
            open_ = open_[(held != pair[open_]) & (held >= 0)]
        return rank

    def merged_lengths(self, pieces: list[str]) -> np.ndarray:
        """Number of symbols that survive in every piece."""
        raw = [p.encode("utf-8") for p in pieces]
        size = np.array([len(p) for p in raw], np.int64)
        out = size.copy()
        for i in np.flatnonzero(size > LONG):
            out[i] = self._merged_by_queue(raw[i])
            raw[i] = b""
        size = np.array([len(p) for p in raw], np.int64)
        symbol = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
        owner = np.repeat(np.arange(len(raw)), size)
        rank = np.full(len(symbol), self.none, np.int32)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self._ranks(symbol[inner], symbol[inner + 1])
        while len(symbol):
            start = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            length = np.diff(np.append(start, len(owner)))
            least = np.minimum.reduceat(rank, start)
            alive = least < self.none
            if not alive.all():  # done sequences leave
                stay = np.repeat(alive, length)
                symbol, owner, rank = symbol[stay], owner[stay], rank[stay]
                least, length = least[alive], length[alive]
                if not len(symbol):
                    break
            # Of places that overlap (a a a) every second one from the left applies.
            place = np.flatnonzero(rank == np.repeat(least, length))
            run = np.concatenate(([True], np.diff(place) > 1))
            place = place[(np.arange(len(place)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2 == 0]
            symbol[place] = self.made[rank[place]]
            out -= np.bincount(owner[place], minlength=len(out))
            stay = np.ones(len(symbol), bool)
            stay[place + 1] = False
            place = place - np.arange(len(place))  # where the merged symbols stand afterwards
            symbol, owner, rank = symbol[stay], owner[stay], rank[stay]
            # Only pairs with a new symbol change.
            changed = np.concatenate((place[place > 0] - 1, place))
            last = (changed + 1 == len(symbol)) | (owner[np.minimum(changed + 1, len(owner) - 1)] != owner[changed])
            rank[changed[last]] = self.none
            changed = changed[~last]
            rank[changed] = self._ranks(symbol[changed], symbol[changed + 1])
        return out

    def _merged_by_queue(self, piece: bytes) -> int:
        """The same merges for one very long piece, where rounds over all of it would be many."""
        symbol = self.byte[np.frombuffer(piece, np.uint8)]
        rank = self._ranks(symbol[:-1], symbol[1:]).tolist()
        symbol = symbol.tolist()
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i) for i, r in enumerate(rank) if r < self.none]
        heapq.heapify(queue)
        rank.append(self.none)
        left = n
        while queue:
            r, i = heapq.heappop(queue)
            if rank[i] != r:
                continue
            gone = after[i]
            symbol[i] = int(self.made[r])
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            rank[gone] = -1
            left -= 1
            for j in (before[i], i):
                if j < 0:
                    continue
                new = self.rank_of.get(symbol[j] * self.size + symbol[after[j]], self.none) if after[j] < n else self.none
                rank[j] = new
                if new < self.none:
                    heapq.heappush(queue, (new, j))
        return left

    def counts(self, texts: list[str]) -> list[int]:
        cut = [self._cut(t) for t in texts]
        words = [w for _, ws, _ in cut for w in ws]
        if len(self.known) > KNOWN:
            self.known = {}
        count = list(map(self.known.get, words))
        at = [i for i, n in enumerate(count) if n is None]
        if at:
            new = list({words[i] for i in at})
            self.known.update(zip(new, self._count([[" " + w] for w in new])))
            for i in at:
                count[i] = self.known[words[i]]
        total = np.concatenate(([0], np.cumsum(np.array(count, np.int64))))
        end = np.cumsum([len(ws) for _, ws, _ in cut], dtype=np.int64)
        of_words = np.diff(total[np.concatenate(([0], end))])
        of_rest = self._count([rest for rest, _, _ in cut])
        return [int(n) + m + extra for n, m, (_, _, extra) in zip(of_words, of_rest, cut)]

    def _count(self, groups: list[list[str]]) -> list[int]:
        """Tokens of all strings of each group."""
        pieces = [[p for part in parts for p in self.split.findall(part)] for parts in groups]
        own = list({p for ps in pieces for p in ps})
        count = dict(zip(own, self.merged_lengths(own).tolist()))
        return [sum([count[p] for p in ps]) for ps in pieces]

    def _cut(self, text: str) -> tuple[list[str], list[str], int]:
        """Strings as they stand, words that a space precedes, and the number of special strings.

        A single space between two characters that are not white space always begins a pre-token,
        so a text without other kinds of space around its spaces may be cut there; words repeat, and
        what is known of them need not be worked out again. Any other text stays as it is.
        """
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            return parts, [], len(parts) - 1
        if not text or text[0] == " " or text[-1] == " " or any(map(text.__contains__, UNEVEN)):
            return [text], [], 0
        first, *words = text.split(" ")
        return [first], words, 0


_mergers: dict[str, RankMerger] = {}


def _merger(path: str) -> RankMerger:
    if path not in _mergers:
        _mergers[path] = RankMerger(path)
    return _mergers[path]


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """A row per document: doc_id, bytes, tokens, and whether there are more than ``limit`` tokens."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(path)
        for batch in batches:
            n_tokens, n_bytes, waiting, chars = [], [], [], 0
            for value in batch["text"]:
                text = value.as_py() or ""
                n_bytes.append(len(text.encode("utf-8")))
                waiting.append(text)
                chars += len(text)
                if chars >= SLICE_CHARS:
                    n_tokens += merger.counts(waiting)
                    waiting, chars = [], 0
            n_tokens += merger.counts(waiting)
            tokens = np.array(n_tokens, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n_bytes, pa.int64()), pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
