"""Token alignment of two tokenizers, on Arrow tables.

Both tokenizers' tokens of a text are laid out by the byte at which they end. Where a token of either ends
at the same byte the text is cut, and the two tokens are linked; the tokens between two cuts are a
group. A link's count is how many links of the whole corpus join the same two ids.

Texts are taken in slices of ``SLICE_BYTES``. A slice's texts are cut into units at spaces that neither
tokenizer joins to what stands before them, distinct units are encoded by the libraries, and from there on all is columns: unit
lists are flattened with their parents' indices, byte lengths are added up by segmented cumulative
sums, an Acero hash join on (document, end) gives the links, and group texts are joined lists. Links are
counted by ``Table.group_by`` within a block of some ``BLOCK_LINKS`` links; Spark merges these partial
counts, and gives every block the counts of its own pairs back. So a pair that every document holds is one row a block, no
table is broadcast, and a task holds one block and the columns of one slice, or one text if that is longer. What Arrow's pool
has kept of them goes back after every block, as workers stay beside the JVM while other stages run.

A tokenizer of which it is not plain that it never joins across such a space gets whole texts as units.

Text that is null, empty, or not the same bytes as either tokenizer's tokens joined has no tokens:
zeros, and an empty ``groups_sha256``. Rows are never matched by ``doc_id``, so null and repeated ids
give a row each, and repeated texts count each time. Only ``doc_id`` and ``text`` are read. An empty
table gives an empty one. Vocabulary files are parameters, read in every worker.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postbud.llm.tokens import PRINTABLE, SPACES
from postbud.session import stage

SLICE_BYTES = 1 << 19
BLOCK_LINKS = 1 << 21
KNOWN = 400_000
ID_BITS = 32
#: A space after something else than a space, before something that no tokenizer takes for white space.
UNIT_GAP = re.compile(f"(?<=[^ ]) (?=[^ {re.escape(SPACES)}])")
UNEVEN = f"^ | $|  | [{SPACES}]"

DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
BLOCKS = f"block long, {DOCUMENT}, codes array<int>, pairs array<long>, n array<long>"


class ByteLevel:
    """Tokenizer A: a byte-level vocabulary of the tokenizers library, without special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        split = file["pre_tokenizer"]
        if split["type"] != "ByteLevel":
            raise ValueError("only byte-level vocabularies are supported")
        self.by_unit = bool(split["use_regex"]) and not split["add_prefix_space"] and not file["normalizer"]
        # Bytes that are not printable are written as the code points from 256 on, in order.
        others = iter(range(256, 512))
        byte_of = {chr(b) if b in PRINTABLE else chr(next(others)): b for b in range(256)}
        self.bytes = [b""] * self.tokenizer.get_vocab_size(True)
        for token, i in file["model"]["vocab"].items():
            self.bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """Tokenizer B: a sentencepiece model, which puts the space before the text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        probe = "  ﬁ Ａ  é "
        as_it_stands = b"".join(self.bytes[i] for i in self.model.encode(probe)) == (" " + probe).encode()
        self.by_unit = as_it_stands and not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def _ragged(lists: list[list[int]]) -> pa.ListArray:
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((x for one in lists for x in one), np.int32, int(size.sum()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(flat))


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.sides = (ByteLevel(path_a), Pieces(path_b))
        self.by_unit = all(s.by_unit for s in self.sides)
        self.length = [pa.array([len(b) for b in s.bytes], pa.int64()) for s in self.sides]
        self.name = [pa.array([str(i) for i in range(len(s.bytes))], pa.large_string()) for s in self.sides]
        self.known = pa.array([], pa.large_string())
        self.ids, self.same = [_ragged([]), _ragged([])], pa.array([], pa.bool_())

    def units(self, texts: pa.Array) -> pa.ListArray:
        """What of each text can be encoded by itself, with a space before it."""
        if not self.by_unit:
            return pa.ListArray.from_arrays(pa.array(range(len(texts) + 1), pa.int32()), texts)
        units = pc.split_pattern(texts, " ")
        odd = np.flatnonzero(pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False))
        if not len(odd):
            return units
        own = pa.array([UNIT_GAP.split(texts[int(i)].as_py()) for i in odd], units.type)
        place = np.arange(len(texts))
        place[odd] = len(texts) + np.arange(len(odd))
        return pa.concat_arrays([units, own]).take(pa.array(place))

    def place(self, units: pa.Array) -> pa.Array:
        """Where ``ids`` and ``same`` have each unit. Units of earlier slices are known, up to ``KNOWN``."""
        place = pc.index_in(units, self.known)
        if not place.null_count:
            return place
        if len(self.known) > KNOWN:
            self.known, self.same, self.ids = self.known[:0], self.same[:0], [x[:0] for x in self.ids]
            place = pa.nulls(len(units), pa.int32())
        new = units.filter(place.is_null())
        ids, same = self.encode(new)
        place = pc.replace_with_mask(
            place, place.is_null(), pa.array(np.arange(len(self.known), len(self.known) + len(new), dtype=np.int32))
        )
        self.known = pa.concat_arrays([self.known, new])
        self.same = pa.concat_arrays([self.same, same])
        self.ids = [pa.concat_arrays(pair) for pair in zip(self.ids, ids)]
        return place

    def encode(self, units: pa.Array) -> tuple[list[pa.ListArray], pa.Array]:
        """Ids of both sides for every unit, and whether their bytes are the unit's."""
        units = units.to_pylist()
        ids = [side.encode(units) for side in self.sides]
        whole = [b" " + u.encode() for u in units]
        same = [
            all(b"".join(map(side.bytes.__getitem__, own[i])) == whole[i] for side, own in zip(self.sides, ids))
            for i in range(len(units))
        ]
        return [_ragged(own) for own in ids], pa.array(same, pa.bool_())

    def align(self, texts: pa.Array) -> tuple[pa.Table, pa.Array, list[str]]:
        """Per text its counts; the ids of all links, texts in order; per text its groups in writing."""
        n = len(texts)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        units = self.units(texts)
        of_unit = pc.list_parent_indices(units).cast(pa.int64())
        words = pc.list_flatten(units).dictionary_encode()
        words = self.place(words.dictionary).take(words.indices)
        broken = pc.binary_length(texts).to_numpy() == 0
        broken[of_unit.filter(pc.invert(self.same.take(words))).to_numpy()] = True
        kept = pa.array(~broken).take(of_unit)
        words, of_unit = words.filter(kept), of_unit.filter(kept)

        tables, flat, sizes = [], [], []
        for side, (lists, length) in enumerate(zip(self.ids, self.length)):
            lists = lists.take(words)
            token = pc.list_flatten(lists)
            doc = of_unit.take(pc.list_parent_indices(lists))
            end = pc.cumulative_sum(length.take(token))
            size = np.bincount(doc.to_numpy(), minlength=n)
            first = np.cumsum(size) - size  # where a document's tokens begin
            before = np.concatenate(([0], end.to_numpy()))[first]
            end = pc.subtract(end, pa.array(before).take(doc))
            tables.append(pa.table({"doc": doc, "end": end, f"at_{side}": pa.array(np.arange(len(token)))}))
            flat.append(token)
            sizes.append(size)
        links = tables[0].join(tables[1], ["doc", "end"], join_type="inner", use_threads=False).sort_by("at_0").combine_chunks()
        at = [links[f"at_{side}"].to_numpy() for side in (0, 1)]
        n_links = np.bincount(links["doc"].to_numpy(), minlength=n)
        written = []
        for side in (0, 1):
            offsets = pa.array(np.concatenate(([0], at[side] + 1)), pa.int32())
            names = self.name[side].take(flat[side])
            written.append(pc.binary_join(pa.ListArray.from_arrays(offsets, names), _text(",")))
        groups = pc.binary_join_element_wise(*written, _text("|"))
        offsets = pa.array(np.concatenate(([0], np.cumsum(n_links))), pa.int32())
        text = pc.binary_join(pa.ListArray.from_arrays(offsets, groups), _text(";"))
        a, b = (flat[side].take(pa.array(at[side])).cast(pa.int64()) for side in (0, 1))
        pairs = pc.bit_wise_or(pc.shift_left(a, pa.scalar(ID_BITS, pa.int64())), b)
        counts = pa.table({"n_a": sizes[0], "n_b": sizes[1], "n_links": n_links})
        return counts, pairs, text.to_pylist()


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``SLICE_BYTES`` of text, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        first = 0
        while first < len(size):
            before = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, before + SLICE_BYTES, "right")), first + 1)
            yield batch.slice(first, last - first)
            first = last


def _block(key: int, parts: list[tuple[pa.Array, pa.Table, pa.Array, list[str]]]) -> Iterator[pa.RecordBatch]:
    """Rows of the block's documents with codes for their links, and a row with the pairs behind the codes."""
    pairs = pa.concat_arrays([p[2] for p in parts])
    counted = pa.table({"pair": pairs}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
    known = counted["pair"].combine_chunks()
    schema = {f.split()[0]: f.split()[1] for f in BLOCKS.split(", ")}
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}

    def batch(rows: int, **columns) -> pa.RecordBatch:
        columns["block"] = pa.array(np.full(rows, key))
        arrays = [columns[c].cast(kinds[k]) if c in columns else pa.nulls(rows, kinds[k]) for c, k in schema.items()]
        return pa.RecordBatch.from_arrays(arrays, list(schema))

    for doc_id, counts, own, digests in parts:
        codes = pc.index_in(own, known).cast(pa.int32())
        n_links = counts["n_links"].combine_chunks()
        ends = pa.array(np.concatenate(([0], np.cumsum(n_links.to_numpy()))).astype(np.int32))
        yield batch(
            len(doc_id), doc_id=doc_id, n_a=counts["n_a"].combine_chunks(), n_b=counts["n_b"].combine_chunks(),
            n_groups=n_links, n_links=n_links, groups_sha256=pa.array(digests, pa.string()),
            codes=pa.ListArray.from_arrays(ends, codes),
        )
    one = pa.array([0, len(known)], pa.int32())
    yield batch(
        1, pairs=pa.ListArray.from_arrays(one, known), n=pa.ListArray.from_arrays(one, counted["count_all"].combine_chunks())
    )


def linked_blocks(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """Documents with their links as codes, and for each block the pairs that the codes stand for."""
    paths = paths or default_files()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, parts, n_links = _aligner(paths), [], 0
        key = TaskContext.get().partitionId() << 32
        for rows in _slices(batches):
            counts, pairs, groups = aligner.align(rows["text"])
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            parts.append((rows["doc_id"], counts, pairs, digests))
            n_links += len(pairs)
            if n_links >= BLOCK_LINKS:
                yield from _block(key, parts)
                parts, n_links, key = [], 0, key + 1
                pa.default_memory_pool().release_unused()
        if parts:
            yield from _block(key, parts)
        del parts
        pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, ``count`` and ``best``: how often two ids are linked, and whether B's id is oftener with none."""
    parts = blocks.where("pairs IS NOT NULL").select(F.inline(F.arrays_zip("pairs", "n")).alias("pair", "n"))
    counts = parts.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND((1 << ID_BITS) - 1))
    counts = stage(counts, "pair_counts")
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return counts.join(top, "b").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def _sums(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums over each document's links, from the counts of its block's pairs."""
    count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
    code = right["code"].to_numpy()
    count[code], best[code] = right["count"].to_numpy(), right["best"].cast(pa.int64()).to_numpy()
    codes = left["codes"].combine_chunks()
    links = pa.table({
        "row": pc.list_parent_indices(codes),
        "best": pa.array(best).take(pc.list_flatten(codes)),
        "count": pa.array(count).take(pc.list_flatten(codes)),
    }).group_by("row", use_threads=False).aggregate([("best", "sum"), ("count", "sum")])
    row, sums = links["row"].to_numpy(), {}
    for c in ("best", "count"):
        sums[c] = np.zeros(left.num_rows, np.int64)
        sums[c][row] = links[f"{c}_sum"].to_numpy()
    kept = [f.split()[0] for f in DOCUMENT.split(", ")]
    return pa.table({**{c: left[c] for c in kept}, "n_best": sums["best"], "count_sum": sums["count"]})


def alignments(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """A row per document: tokens, groups, links, links to B's most frequent partner, counts, digest."""
    blocks = stage(linked_blocks(docs, paths), "aligned")
    counts = stage(pair_counts(blocks), "pair_tops")
    parts = blocks.where("pairs IS NOT NULL").select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("code", "pair"))
    # A pair is one row a block at most, and both sides are plain shuffles that AQE can split.
    lookup = parts.join(counts, "pair").select("of_block", "code", "count", "best")
    rows = blocks.where("pairs IS NULL").select("block", *[f.split()[0] for f in DOCUMENT.split(", ")], "codes")
    return rows.groupBy("block").cogroup(lookup.groupBy("of_block")).applyInArrow(_sums, f"{DOCUMENT}, n_best long, count_sum long")
