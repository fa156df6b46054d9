"""Words, shingles and hashes of whole batches of texts, on flat numpy arrays.

A batch of texts is one array of bytes with offsets, so a pass costs a few array operations per
byte, not a Python step per word. Batches are cut into slices of a few megabytes first, which
bounds memory: only a single text that is longer than that makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
SLICE_ROWS = 1000
SHINGLE_WORDS = 5
#: Shingle hashes keep this many bits; the rest of a sort key holds the row in its slice.
SHINGLE_BITS = 54

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but letters and digits.
PUNCTUATION = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_powers = {int(_BASE): np.ones(1, np.uint64), int(BASE_INVERSE): np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (finaliser of public murmur3)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers[int(base)]
    if len(have) < n:
        steps = np.full(max(n, SLICE_BYTES), base, np.uint64)
        steps[0] = 1
        have = _powers[int(base)] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` turns a pair of them into the hash of a span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * power(_BASE, len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes in every [start, end), the same wherever they lie."""
    return mix((sums[end] - sums[start]) * power(BASE_INVERSE, len(sums))[start])


def slices(
    texts: pa.Array | pa.ChunkedArray, lower: bool = False, rows: int = SLICE_ROWS
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; null reads as the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if lower:
        texts = pc.utf8_lower(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), first + rows, len(texts))
        yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def words(
    data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes that are not in ``gap``, ASCII white space if not said."""
    solid = np.concatenate(([False], ~gap[data], [False]))
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(solid[1:] & (~solid[:-1] | cut))
    ends = np.flatnonzero(solid[:-1] & (~solid[1:] | cut))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of every distinct five-word shingle, by row and hash.

    A text of one to four words is one shingle; a text without words has none.
    """
    starts, ends, row = words(data, offsets)
    n = len(starts)
    if not n:
        empty = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), empty, np.zeros(0, np.int64)
    word = span_hash(prefix_hash(data), starts, ends)
    per_row = np.bincount(row, minlength=len(offsets) - 1)
    place = np.arange(n) - (np.cumsum(per_row) - per_row)[row]
    left = per_row[row] - place
    word = np.concatenate((word, np.zeros(SHINGLE_WORDS - 1, np.uint64)))
    out = np.zeros(n, np.uint64)
    for j in range(SHINGLE_WORDS):
        part = word[j : j + n] * np.uint64(2 * j + 0x51ED270B)
        part[left <= j] = 0
        out = mix(out + part)
    whole = (left >= SHINGLE_WORDS) | ((place == 0) & (per_row[row] < SHINGLE_WORDS))
    key = (out[whole] >> np.uint64(64 - SHINGLE_BITS)) | (
        row[whole].astype(np.uint64) << np.uint64(SHINGLE_BITS)
    )
    key.sort()
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.append(new, len(key)))
    key = key[new]
    return (
        (key >> np.uint64(SHINGLE_BITS)).astype(np.int64),
        key & np.uint64((1 << SHINGLE_BITS) - 1),
        count,
    )
