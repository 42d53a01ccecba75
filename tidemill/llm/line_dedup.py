"""Line deduplication with two Bloom filters.

Every text is split at newlines.  A line's key is the line without white space at its ends and with
A-Z lower-cased.  A key of at least ``MIN_CODE_POINTS`` code points that is found in two documents or
more loses all its lines except those in the smallest document id holding it.

1. Each task adds the keys of its documents, once per document, to a pair of Bloom filters: a key
   that the first filter holds already goes into the second.  Only the filters' set bits leave the
   task.  Merged segment by segment, the second filter takes up what two tasks' first filters share;
   it holds every key of two documents, and few others.  The first filter grows with the corpus
   and is held a segment at a time; the second is folded while it is sparse, down to what may be
   broadcast.  A fuller filter costs more suspects, never a wrong result.
2. Only keys that the second filter holds are shuffled, as 128-bit digests with their document,
   for the exact test and the choice of the first occurrence.
3. The digests of confirmed keys go back to the lines: broadcast while they are at most
   ``BROADCAST_KEYS``, else to the suspect documents alone, joined by document id.

Nulls: a null or empty text is one empty line; a null one stays null.  A null document id comes first in
order.  Rows that share a document id are one document: a key in no other document stays in all of
them, so there are no ties.  A very long text is split by one task in memory of a few times its size.
An empty table gives no rows.  Columns named like the added ones are replaced, other columns stay,
whatever their names.

The driver holds the second filter (``BROADCAST_BYTES`` at most) and, when they are broadcast, the
digests (``BROADCAST_KEYS`` of 24 bytes), whatever the corpus.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import bloom
from tidemill.llm.bytetext import LOWER, SPACE, U64, hashes, slices
from tidemill.scratch import written

MIN_CODE_POINTS = 10
#: Bytes of text per expected key, and bits of the first filter per expected key.
BYTES_PER_KEY, BITS_PER_KEY = 32, 16
#: The second filter's bytes when broadcast, at most, and how full folding may make it.
BROADCAST_BYTES, FULL = 1 << 25, 0.05
BROADCAST_KEYS = 1 << 20
#: Partial filters that one task merges at a time.
FAN_IN = 64
#: Hashes that a task holds before it gives out its set bits.
FLUSH_KEYS = 1 << 22
DIGEST = 16
_NONE = -(1 << 63)
#: Names beside the input's own columns.
OWN, LOSING = "__tidemill_own", "__tidemill_losing"


class Lines:
    """The lines of a batch of texts: ``doc``, ``start`` and ``end`` of each, the key's ``first`` and ``last``, ``long`` keys and their ``hash``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, least: int):
        breaks = np.flatnonzero(data == 10)
        n = np.diff(np.searchsorted(breaks, offsets)) + 1
        self.data, self.count = data, n
        self.doc = np.repeat(np.arange(len(n)), n)
        self.begin = np.cumsum(n) - n
        start, end = np.empty(len(self.doc), np.int64), np.empty(len(self.doc), np.int64)
        inner = np.ones(len(start), dtype=bool)
        inner[self.begin] = False
        start[inner], start[self.begin] = breaks + 1, offsets[:-1]
        inner[:] = True
        inner[self.begin + n - 1] = False
        end[inner], end[self.begin + n - 1] = breaks, offsets[1:]
        solid = np.flatnonzero(~SPACE[data])
        a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
        full = a < b
        first, last = start.copy(), start.copy()
        first[full], last[full] = solid[a[full]], solid[b[full] - 1] + 1
        points = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=points[1:])
        self.start, self.end, self.first, self.last = start, end, first, last
        self.long = np.flatnonzero(points[last] - points[first] >= least)
        self.hash = hashes(data, first[self.long], last[self.long])

    def digest(self, line: int) -> bytes:
        key = LOWER[self.data[self.first[line] : self.last[line]]]
        return hashlib.blake2b(key.tobytes(), digest_size=DIGEST).digest()


class _Partial:
    """A task's filters: which hashes it has seen, and which of them in two documents."""

    names = ["segment", "once", "twice"]
    schema = "segment int, once binary, twice binary"

    def __init__(self, layout: tuple[int, int]):
        self.layout, self.seen, self.again, self.n = layout, [], [], 0

    def add(self, lines: Lines) -> None:
        order = np.lexsort((lines.doc[lines.long], lines.hash))
        h, d = lines.hash[order], lines.doc[lines.long][order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        self.seen.append(h[new])
        self.n += int(new.sum())

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Its set bits, a row per segment; it is empty afterwards."""
        seen = np.sort(np.concatenate(self.seen)) if self.seen else np.zeros(0, U64)
        self.seen, self.n = [], 0
        new = np.ones(len(seen), dtype=bool)
        new[1:] = seen[1:] != seen[:-1]
        again = np.unique(seen[~new])
        (segment, places), (segment2, places2) = bloom.place(seen[new], *self.layout), bloom.place(again, *self.layout)
        own = np.unique(segment)
        bounds, bounds2 = np.searchsorted(segment, [*own, 1 << 62]), np.searchsorted(segment2, [*own, 1 << 62])
        once = [bloom.packed(np.unique(places[:, a:b])) for a, b in zip(bounds, bounds[1:], strict=False)]
        twice = [bloom.packed(np.unique(places2[:, a:b])) for a, b in zip(bounds2, bounds2[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], names=self.names)


def _filters(docs: DataFrame, layout: tuple[int, int], least: int, text: str) -> DataFrame:
    """(segment, twice): the merged second filter."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partial = _Partial(layout)
        for _, data, offsets in slices(batches, text):
            partial.add(Lines(data, offsets, least))
            if partial.n > FLUSH_KEYS:
                yield from partial.rows()
        yield from partial.rows()

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = bloom.empty(layout[1]), bloom.empty(layout[1])
        for batch in batches:
            for a, b in zip(batch.column("once"), batch.column("twice"), strict=True):
                other = bloom.unpacked(a.as_py())
                bloom.add(twice, other[bloom.test(once, other)])
                bloom.add(twice, bloom.unpacked(b.as_py()))
                bloom.add(once, other)
        bits = [pa.array([bloom.packed(bloom.set_places(x))], pa.binary()) for x in (once, twice)]
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), *bits], names=_Partial.names)

    some = docs.select(text).mapInArrow(build, _Partial.schema).withColumn("part", F.floor(F.spark_partition_id() / FAN_IN))
    for by in (["segment", "part"], ["segment"]):
        some = some.groupBy(*by).applyInArrow(merge, _Partial.schema)
    return some.select("segment", "twice")


def _second(docs: DataFrame, least: int, text: str) -> tuple[np.ndarray, tuple[int, int]]:
    """The folded second filter, a row per segment, and its layout."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    layout = segments, bits = bloom.layout(total / BYTES_PER_KEY * BITS_PER_KEY)
    made = written(_filters(docs, layout, least, text), "twice")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(bloom.unpacked(x.as_py())) for x in batch.column("twice")], pa.int64())], names=["n"])

    # Folding doubles how full the filter is, at most; beyond FULL only the bound on its size asks for it.
    n = made.select("twice").mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0
    sparse = int(math.log2(FULL * (1 << segments + bits) / max(n, 1))) if n < FULL * (1 << segments + bits) else 0
    steps = max(min(sparse, bits - 10), segments + bits - int(math.log2(BROADCAST_BYTES * 8)), 0)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column("twice"):
                own = bloom.empty(bits - steps)
                bloom.add(own, np.unique(bloom.unpacked(x.as_py()) >> steps))
                out.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("segment"), pa.array(out, pa.binary())], names=["segment", "twice"])

    out = np.zeros((1 << segments, len(bloom.empty(bits - steps))), dtype=np.uint8)
    for r in made.mapInArrow(fold, "segment int, twice binary").toLocalIterator():
        out[r["segment"]] = np.frombuffer(bytes(r["twice"]), dtype=np.uint8)
    return out, (segments, bits - steps)


def _suspect(lines: Lines, second: np.ndarray, layout: tuple[int, int]) -> np.ndarray:
    """The lines whose keys the second filter holds."""
    segment, places = bloom.place(lines.hash, *layout)
    return lines.long[bloom.test(second.reshape(-1), places + segment * (second.shape[1] * 8)).all(axis=0)]


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_CODE_POINTS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``docs`` with ``text`` replaced by its lines that stay, and n_lines (before) and n_dropped added or replaced."""
    spark, docs = docs.sparkSession, docs.drop("n_lines", "n_dropped")
    second, layout = _second(docs, least, text)
    shared = spark.sparkContext.broadcast(second)
    ids = F.coalesce(F.col(key).cast("long"), F.lit(_NONE))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "t"):
            lines = Lines(data, offsets, least)
            own = rows.column(0).to_numpy(zero_copy_only=False)
            found = {(own[lines.doc[i]], lines.digest(i)) for i in _suspect(lines, shared.value, layout).tolist()}
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([k for _, k in found], pa.binary())], names=["doc", "digest"])

    found = written(docs.select(ids.alias("doc"), F.col(text).alias("t")).mapInArrow(suspects, "doc long, digest binary"), "suspects")
    # Ids come once per key and document: a key is in two documents if its least and largest differ.
    firsts = found.groupBy("digest").agg(F.min("doc").alias("keeper"), F.max("doc").alias("last")).filter("keeper < last").select("digest", "keeper")
    firsts = written(firsts, "firsts")

    body = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    fields = [T.StructField(f.name, f.dataType, True) for f in body.fields]
    at, width = docs.columns.index(text), len(docs.columns)
    names = [f.name for f in fields]

    def kept(rows: pa.RecordBatch, lines: Lines, dropped: np.ndarray) -> pa.RecordBatch:
        stays = np.ones(len(lines.doc), dtype=bool)
        stays[dropped] = False
        raw, out = lines.data.tobytes(), rows.column(at).to_pylist()
        for d in np.unique(lines.doc[dropped]).tolist():
            own = np.flatnonzero(stays[lines.begin[d] : lines.begin[d] + lines.count[d]]) + lines.begin[d]
            out[d] = b"\n".join(raw[a:b] for a, b in zip(lines.start[own].tolist(), lines.end[own].tolist(), strict=True)).decode()
        gone = np.bincount(lines.doc[dropped], minlength=len(lines.count))
        columns = [*rows.columns[:width]]
        columns[at] = pa.array(out, pa.string())
        return pa.RecordBatch.from_arrays([*columns, pa.array(lines.count.astype(np.int64)), pa.array(gone.astype(np.int64))], names=names)

    if firsts.count() <= broadcast_keys:
        known = firsts.toArrow()
        digests = _fixed(known.column(0).to_pylist())
        order = np.argsort(digests)
        table = spark.sparkContext.broadcast((digests[order], known.column(1).to_numpy()[order]))

        def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, keepers = table.value
            for rows, data, offsets in slices(batches, text):
                lines = Lines(data, offsets, least)
                own = rows.column(width).to_numpy(zero_copy_only=False)
                maybe = _suspect(lines, shared.value, layout)
                if len(keys) and len(maybe):
                    digest = _fixed([lines.digest(i) for i in maybe.tolist()])
                    i = np.minimum(np.searchsorted(keys, digest), len(keys) - 1)
                    maybe = maybe[(keys[i] == digest) & (keepers[i] != own[lines.doc[maybe]])]
                else:
                    maybe = maybe[:0]
                yield kept(rows, lines, maybe)

        return docs.select("*", ids.alias(OWN)).mapInArrow(narrow, T.StructType(fields))

    losing = found.join(firsts, "digest").filter("doc != keeper").groupBy(F.col("doc").alias(OWN)).agg(F.array_join(F.collect_list(F.hex("digest")), "").alias(LOSING))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, text):
            lines = Lines(data, offsets, least)
            lost = [frozenset(bytes.fromhex(x[i : i + 2 * DIGEST]) for i in range(0, len(x), 2 * DIGEST)) if x else frozenset() for x in rows.column(width).to_pylist()]
            gone = [i for i in lines.long.tolist() if lost[lines.doc[i]] and lines.digest(i) in lost[lines.doc[i]]]
            yield kept(rows, lines, np.array(gone, dtype=np.int64))

    marked = docs.select("*", ids.alias(OWN)).join(losing, OWN, "left")
    return marked.select(*docs.columns, LOSING).mapInArrow(joined, T.StructType(fields))


def _fixed(digests: list[bytes]) -> np.ndarray:
    """Digests as an array of byte strings of one length, which sort and compare as they are."""
    return np.frombuffer(b"".join(digests), dtype=f"S{DIGEST}")
