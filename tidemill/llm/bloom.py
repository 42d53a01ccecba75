"""Bloom filters in segments.

The top bits of a hash pick the segment, further bits the places in it, so that tasks build and
merge segments apart and none holds the whole filter.  Tasks exchange set bits, as packed lists of
places.
"""

from __future__ import annotations

import zlib

import numpy as np

from tidemill.llm.bytetext import U64, mix

PROBES = 3
#: log2 of the fewest segments, and of a segment's bits at most.
LEAST_SEGMENTS, SEGMENT_BITS = 6, 26


def layout(bits: float) -> tuple[int, int]:
    """log2 of the segments and of the bits of each, for that many bits in all."""
    total = max(16, int(np.ceil(np.log2(max(1.0, bits)))))
    segments = max(LEAST_SEGMENTS, total - SEGMENT_BITS)
    return segments, total - segments


def place(hashes: np.ndarray, log2_segments: int, log2_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each hash and its places (a row per probe) in the segment."""
    segment = (hashes >> U64(64 - log2_segments)).astype(np.int64)
    a = mix(hashes)
    b = mix(a ^ U64(0x5851F42D4C957F2D)) | U64(1)
    return segment, np.stack([((a + U64(k) * b) >> U64(64 - log2_bits)).astype(np.int64) for k in range(PROBES)])


def empty(log2_bits: int) -> np.ndarray:
    return np.zeros(max(1, (1 << log2_bits) // 8), dtype=np.uint8)


def add(bits: np.ndarray, places: np.ndarray) -> None:
    """Set the bits at sorted distinct places."""
    if not len(places):
        return
    at, value = places >> 3, np.left_shift(np.uint8(1), (places & 7).astype(np.uint8))
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    bits[at[first]] |= np.bitwise_or.reduceat(value, first)


def test(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1).astype(bool)


def set_places(bits: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits, bitorder="little"))


def packed(places: np.ndarray) -> bytes:
    return zlib.compress(np.diff(places, prepend=0).astype("<u4").tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), dtype="<u4").astype(np.int64))


def of(df, column: str, most_bytes: int):
    """A filter of the 64-bit values of a column, (bits, layout), of at most ``most_bytes``.

    Tasks give out set bits, others merge them by segment; the driver holds no more than the filter.
    """
    import pyarrow as pa
    from pyspark.sql import functions as F

    n = df.agg(F.count(column)).first()[0]
    segments, bits = own = layout(min(16.0 * max(n, 1), most_bytes * 8.0))

    def build(batches):
        for batch in batches:
            values = mix(batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(U64))
            values.sort()
            segment, places = place(values, *own)
            found = np.unique(segment)
            bounds = np.searchsorted(segment, [*found, 1 << 62])
            data = [packed(np.unique(places[:, a:b])) for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(data, pa.binary())], names=["segment", "places"])

    def merge(key: tuple[pa.Scalar, ...], batches):
        out = empty(bits)
        for batch in batches:
            for x in batch.column("places"):
                add(out, unpacked(x.as_py()))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([out.tobytes()], pa.binary())], names=["segment", "places"])

    from collections.abc import Iterator

    merge.__annotations__.update(batches=Iterator[pa.RecordBatch], key=tuple[pa.Scalar, ...])
    merge.__annotations__["return"] = Iterator[pa.RecordBatch]
    schema = "segment int, places binary"
    out = np.zeros((1 << segments, len(empty(bits))), dtype=np.uint8)
    for r in df.select(column).mapInArrow(build, schema).groupBy("segment").applyInArrow(merge, schema).toLocalIterator():
        out[r["segment"]] = np.frombuffer(bytes(r["places"]), dtype=np.uint8)
    return out, own


def holds(filter_: np.ndarray, own: tuple[int, int], values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit values a filter made by ``of`` may hold."""
    segment, places = place(mix(values.astype(np.int64).view(U64)), *own)
    return test(filter_.reshape(-1), places + segment * (filter_.shape[1] * 8)).all(axis=0)
