"""Vectorised kernels over the UTF-8 bytes of many texts at once.

A batch of texts is one byte array and the offsets of the texts in it, as Arrow stores them.
Memory is a small multiple of the batch, and of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK = 1 << 18
BATCH_BYTES = 1 << 18

#: The white space of every contract here: space and the control characters 9 to 13.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = mix(np.arange(1, 257, dtype=U64))


def _powers(base: int) -> np.ndarray:
    out = np.full(CHUNK + 1, base, dtype=U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


_UP, _DOWN = _powers(_BASE), _powers(_INVERSE)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of the batches with about ``limit`` bytes of text, as (rows, bytes, offsets); a null text is empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")
        ends = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2], dtype=np.uint8) if text.buffers()[2] is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
            offsets = ends[at : to + 1]
            yield batch.slice(at, to - at), data[offsets[0] : offsets[-1]], offsets - offsets[0]
            at = to
        del text, ends, data
    pa.default_memory_pool().release_unused()


def spans_of(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run ends with its text."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, lasts = mask.copy(), mask.copy()
    starts[1:] &= ~mask[:-1]
    lasts[:-1] &= ~mask[1:]
    cut = offsets[:-1][offsets[:-1] < len(mask)]
    starts[cut] = mask[cut]
    cut = offsets[1:][offsets[1:] > 0] - 1
    lasts[cut] = mask[cut]
    return np.flatnonzero(starts), np.flatnonzero(lasts) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not white space."""
    return spans_of(~SPACE[data], offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of data[start:end]; the spans are in order and do not overlap.

    A polynomial in an odd base over random codes of the bytes, from prefix sums that are made a
    chunk at a time, so that one very long text needs no more than its spans.
    """
    codes = _CODES[LOWER] if lower else _CODES
    at = np.empty((2, len(starts)), dtype=U64)
    total, scale = U64(0), 1
    inverse = np.empty(len(starts), dtype=U64)
    down = 1
    for base in range(0, max(len(data), 1), CHUNK):
        part = data[base : base + CHUNK]
        sums = np.empty(len(part) + 1, dtype=U64)
        sums[0] = 0
        np.cumsum(codes[part] * _UP[: len(part)], dtype=U64, out=sums[1:])
        with np.errstate(over="ignore"):
            sums = total + sums * U64(scale)
        a, b = np.searchsorted(starts, (base, base + len(part)))
        at[0, a:b] = sums[starts[a:b] - base]
        inverse[a:b] = _DOWN[starts[a:b] - base] * U64(down)
        a, b = np.searchsorted(ends, (base + 1, base + len(part) + 1))
        at[1, a:b] = sums[ends[a:b] - base]
        total = sums[-1]
        scale = scale * int(_UP[CHUNK]) % (1 << 64)
        down = down * int(_DOWN[CHUNK]) % (1 << 64)
    return mix((at[1] - at[0]) * inverse + (ends - starts).astype(U64))


def counts_in(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the sorted positions each text has."""
    return np.diff(np.searchsorted(starts, offsets))


def shingles(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of each text, and how many each has.

    A text of fewer words has its whole sequence as its one shingle; one without words has none.
    """
    total = np.zeros(len(words), dtype=U64)
    n = len(words)
    ends = np.repeat(np.cumsum(counts), counts)
    left = ends - np.arange(n)
    short = np.repeat(counts < width, counts)
    for k in range(width):
        term = np.zeros(n, dtype=U64)
        term[: n - k] = words[k:] if k else words
        term[left <= k] = 0
        total = mix(total + U64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64)) + term)
    first = np.zeros(n, dtype=bool)
    begin = np.cumsum(counts) - counts
    first[begin[counts > 0]] = True
    keep = (left >= width) | (short & first)
    # A short sequence must differ from a full one that begins alike.
    total[short] = mix(total[short] ^ left[short].astype(U64))
    return total[keep], np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
