"""Word positions and word hashes of whole text columns, as numpy arrays.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. Texts are handled in blocks of about half a megabyte, so memory follows the block
(or the longest single text), not the batch or the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19
#: Bytes of words that are hashed at a time.
HASH_BYTES = 1 << 17
SPACES = [9, 10, 11, 12, 13, 32]


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_blocks(
    column: pa.Array, limit: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of up to `limit` bytes, or of
    one longer text. A null is an empty text. Bytes of a string column without nulls are not copied."""
    if not pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    kind = np.int32 if pa.types.is_string(column.type) else np.int64
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(column))
        own = offsets[first : end + 1]
        yield first, end, data[own[0] : own[-1]], own - own[0]
        first = end


def find_words(data: np.ndarray, offsets: np.ndarray):
    """(start, end) byte of every word, and per text the number of words before it."""
    space = np.zeros(256, bool)
    space[SPACES] = True
    blank = space[data]
    begins, ends = ~blank, ~blank
    begins[1:] &= blank[:-1]
    ends[:-1] &= blank[1:]
    if len(data):
        for marks, at in ((begins, offsets[:-1]), (ends, offsets[1:] - 1)):
            at = at[(at >= 0) & (at < len(data))]
            marks[at] |= ~blank[at]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The words' bytes without what lies between, and where each word begins there."""
    lengths = ends - starts
    begins = np.cumsum(lengths) - lengths
    take = np.arange(lengths.sum()) + np.repeat(starts - begins, lengths)
    return data[take], begins, lengths


def hash_words(data, starts, ends, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of every word; another odd `factor` gives an independent one. Words are taken
    `HASH_BYTES` at a time, as their bytes become several arrays of eight times the size."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    upto = np.cumsum(ends - starts)
    table = np.full(min(int((ends - starts).max()), 1 << 16), factor, np.uint64)
    table[0] = 1
    table = np.cumprod(table, dtype=np.uint64)
    out, first, done = np.empty(len(starts), np.uint64), 0, 0
    while first < len(starts):
        end = max(int(np.searchsorted(upto, done + HASH_BYTES, "right")), first + 1)
        out[first:end] = _hashed(data, starts[first:end], ends[first:end], table)
        first, done = end, int(upto[end - 1])
    return out


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    own, begins, lengths = word_bytes(data, starts, ends)
    at = np.arange(len(own)) - np.repeat(begins, lengths)
    weights = table[at & 0xFFFF]
    if len(table) == 1 << 16:
        weights *= 2 * (at >> 16).astype(np.uint64) + np.uint64(1)
    weights *= own.astype(np.uint64) + np.uint64(1)
    return splitmix(np.add.reduceat(weights, begins) + lengths.astype(np.uint64))


def window_hash(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from every position on (positions near the end are cut off)."""
    made, width, out, done = words, 1, None, 0
    rest = size
    while rest:
        if rest & 1:
            part = made[done : len(made)]
            out = part if out is None else _paired(out, part)
            done += width
        rest >>= 1
        if rest:
            made, width = _paired(made, made[width:]), 2 * width
    return out


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    n = min(len(left), len(right))
    return splitmix(left[:n] * np.uint64(0xD6E8FEB86659FD93) + right[:n])


def window_starts(word_offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions where a whole window of one text starts, and the text of each."""
    counts = np.maximum(np.diff(word_offsets) - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + (word_offsets[:-1] - first)[text], text


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Least of `size` consecutive values, from every position on."""
    width = 1
    while 2 * width <= size:
        values, width = np.minimum(values[:-width], values[width:]), 2 * width
    rest = size - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values
