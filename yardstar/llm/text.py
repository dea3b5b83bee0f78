"""Words and their hashes for whole Arrow batches of texts, in numpy.

A text column is one buffer of UTF-8 bytes, so a batch is cut into words and
hashed with a few passes over that buffer instead of a loop over its words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

# An odd multiplier has an inverse modulo 2**64, so the hash of a word is the
# difference of two prefix sums, brought back to the word's own start.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Words(NamedTuple):
    hash: np.ndarray  # uint64 of each word
    text: np.ndarray  # index of the text it stands in
    start: np.ndarray  # first byte in the buffer
    end: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffer(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a NULL counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    cut = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(cut) or cut[-1] == cut[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[cut[0] : cut[-1]], cut - cut[0]


KEPT_POWERS = 1 << 20
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64) -> np.ndarray:
    """The first ``n`` powers of ``base``; a worker keeps the first million of each base, which most batches can do with."""
    if n > KEPT_POWERS:
        return _made_powers(n, base)
    if int(base) not in _powers:
        _powers[int(base)] = _made_powers(KEPT_POWERS, base)
    return _powers[int(base)][:n]


def _made_powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``; equal spans have equal hashes wherever they stand."""
    if not len(start):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), BASE), out=total[1:])
    return mix((total[end] - total[start]) * powers(len(data), BASE_INVERSE)[start] + (end - start).astype(np.uint64))


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, end)`` of maximal runs without white space; none crosses from one text into the next."""
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    border = offsets[1:-1]
    border = border[(border > 0) & (border < len(data))]
    first[border] = inside[border]
    last[border - 1] = inside[border - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(offsets, start, "right") - 1, start, end


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Maximal runs without white space, and their hashes."""
    text, start, end = spans(data, offsets)
    return Words(span_hash(data, start, end), text, start, end)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20):
    """Cut a batch into pieces of about ``max_bytes`` of text, at least one row each, to bound the memory of a pass."""
    texts = batch.column(column)
    if not len(texts):
        return
    _, offsets = buffer(texts)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end
