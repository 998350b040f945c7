"""Vectorised word and character work inside tasks.

Everything here runs on numpy arrays over a bounded chunk of texts, so a task
holds a few megabytes of temporaries whatever the size of its partition. A
word is a run of bytes other than 0x20 and 0x09-0x0D; as these are ASCII, the
runs of UTF-8 bytes are the runs of characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
# Odd multipliers of the hashes.
P_BYTE = np.uint64(0x9E3779B97F4A7C15)
P_WORD = np.uint64(0xD1B54A32D192ED03)

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (the published splitmix64 mixing step)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, document offsets) of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows holding about ``limit`` bytes together."""
    data, offsets = text_buffers(column)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True that do not cross a document: (starts, ends, run offsets by document)."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(inside), dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(inside), dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run, taking eight bytes at a time."""
    lengths = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    h = mix((eights[starts] & LOW_BYTES[np.minimum(lengths, 8)]) + lengths.astype(np.uint64) * P_WORD)
    k, live = 8, np.flatnonzero(lengths > 8)
    while len(live):
        piece = eights[starts[live] + k] & LOW_BYTES[np.minimum(lengths[live] - k, 8)]
        h[live] = mix((h[live] ^ piece) * P_BYTE)
        k += 8
        live = live[lengths[live] > k]
    return h


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word offsets by document)."""
    starts, ends, by_doc = runs(~BLANK[data], offsets)
    return hash_runs(data, starts, ends), by_doc


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, at each start (document borders are not looked at)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, width, todo, power = None, 0, k, 1
    level, p = h, P_WORD
    with np.errstate(over="ignore"):
        while todo:
            if todo & 1:
                if out is None:
                    out = level[:n].copy()
                else:
                    out = out * p + level[width : width + n]
                width += power
            todo >>= 1
            if todo:
                level = level[: len(level) - power] * p + level[power:]
                p = p * p
                power *= 2
    return mix(out)


def gram_starts(by_doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions in the word array at which a k-word window lies in one document, offsets by document)."""
    counts = np.maximum(np.diff(by_doc) - k + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(offsets[-1]) + np.repeat(by_doc[:-1] - offsets[:-1], counts)
    return at, offsets


def shingle_sets(column: pa.Array, size: int = 5, lower: bool = True) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in row order.

    Fewer words than ``size`` make one shingle of the whole sequence; no word
    makes an empty set.
    """
    for lo, hi, data, offsets in chunks(column):
        h, by_doc = words(LOWER[data] if lower else data, offsets)
        every = grams(h, size)
        for d in range(hi - lo):
            a, b = by_doc[d], by_doc[d + 1]
            if b - a >= size:
                yield distinct(every[a : b - size + 1])
            elif b > a:
                yield mix(grams(h[a:b], int(b - a)) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start, start + count)."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
