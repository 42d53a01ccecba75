"""Best-fit packing of token pieces into sequences.

``pieces`` tokenises whole texts; ``pack`` places rows with a length into sequences.  Packing is
bounded-space online best-fit: a partition streams its rows, as they arrive, past ``OPEN_BINS`` open
bins at most, which are kept in a bitset by free space.  A row goes to the fullest bin that still
takes it; when none does and all places are used, the fullest bin closes.  Rows leave the task when
their bin closes, so it holds what open bins hold and no more.

The rows of bins that remain open at the end of a partition, ``OPEN_BINS`` bins of it at most, are placed once
more by the same rule: dealt by a hash into groups of ``GROUP_BINS`` bins' worth, in which they arrive in
the order of that hash, whatever their lengths.  So many small partitions waste little, no task of the second
pass grows with their number, and where partitions are large few rows come through it.

Nulls: a null text is empty and has one piece, the end token.  Rows with equal ids are packed each
for itself; ties go to the bin that was opened or refilled last.  An empty table gives no rows.  A very
long text is tokenised whole, by one task.  Further columns stay with their rows; those named like
an added one are replaced, and ``pack_texts`` leaves all but the key and the text out.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.scratch import written

#: More open bins find no better fits on the texts tried, and leave more rows to the second pass.
OPEN_BINS = 128
#: Bins' worth of tokens in a group of the second pass, times the open bins.
GROUP_BINS = 32
#: Rows after which those of closed bins are given out, at least.
FLUSH = 4096


class Bins:
    """A bounded number of open bins in a bitset: bit ``f`` is set while a bin has ``f`` free."""

    def __init__(self, capacity: int, limit: int, first: int = 0):
        self.capacity, self.limit, self.next = capacity, limit, first
        self.bits, self.by_free, self.n = 0, {}, 0

    def place(self, length: int) -> tuple[int, int]:
        """The sequence and the offset in it for a piece of 1 to ``capacity``."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            at = self._take(free)
        else:
            if self.n == self.limit and length < self.capacity:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, at = self.capacity, self.next
            self.next += 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(at)
            self.bits |= 1 << left
            self.n += 1
        return at, self.capacity - free

    def _take(self, free: int) -> int:
        same = self.by_free[free]
        at = same.pop()
        self.n -= 1
        if not same:
            del self.by_free[free]
            self.bits ^= 1 << free
        return at

    def open(self) -> list[int]:
        return [at for same in self.by_free.values() for at in same]


def _placed(bins: Bins, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each row, placed as they arrive."""
    out = np.empty((len(lengths), 2), dtype=np.int64)
    for i, n in enumerate(lengths.tolist()):
        out[i] = bins.place(n)
    return out[:, 0], out[:, 1]


def _with(batch: pa.RecordBatch, names: list[str], **more) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(more[n]) for n in names)], names=[*batch.schema.names, *names])


def _free_name(columns: list[str], name: str) -> str:
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _nullable(fields) -> list[T.StructField]:
    return [T.StructField(f.name, f.dataType, True) for f in fields]


def pack(df: DataFrame, length: str, capacity: int, open_bins: int = OPEN_BINS, sequence: str = "sequence_id", offset: str = "offset", cut=None) -> DataFrame:
    """Add the ``sequence`` and ``offset`` of every row; lengths are from 1 to ``capacity``.

    Columns of ``df`` with these names are replaced.  ``cut``, a function over record batches and the
    schema that it makes, is applied to the rows first, in the same pass.  Both passes are written
    to the shared scratch folder, so that a later loss of executors repeats nothing.
    """
    if cut is None:
        df = df.drop(sequence, offset)
        cut = iter, df.schema
    cut, made = cut
    mark = _free_name(made.names, "_loose")
    out = T.StructType([*_nullable(made.fields), T.StructField(sequence, T.LongType()), T.StructField(offset, T.LongType())])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, held, fresh = Bins(capacity, open_bins, TaskContext.get().partitionId() << 40), [], 0

        def sorted_out(last: bool) -> Iterator[pa.RecordBatch]:
            rows = pa.concat_batches(held)
            still = np.isin(rows.column(rows.schema.get_field_index(sequence)).to_numpy(), bins.open())
            yield _with(rows.filter(pa.array(~still)), [mark], **{mark: np.zeros(int((~still).sum()), dtype=bool)})
            held[:] = [rows.filter(pa.array(still))]
            if last:
                yield _with(held[0], [mark], **{mark: np.ones(held[0].num_rows, dtype=bool)})

        for batch in cut(batches):
            at, off = _placed(bins, batch.column(batch.schema.get_field_index(length)).to_numpy())
            held.append(_with(batch, [sequence, offset], **{sequence: at, offset: off}))
            fresh += batch.num_rows
            # So often that copying what is held costs no more than what arrives.
            if fresh >= max(FLUSH, held[0].num_rows):
                yield from sorted_out(False)
                fresh = 0
        if held:
            yield from sorted_out(True)

    once = written(df.mapInArrow(first, T.StructType([*out.fields, T.StructField(mark, T.BooleanType())])), "packed")
    loose, closed = once.filter(F.col(mark)).drop(mark), once.filter(~F.col(mark)).drop(mark)
    tokens = loose.agg(F.sum(length)).first()[0] or 0
    groups = max(1, math.ceil(tokens / (capacity * open_bins * GROUP_BINS)))
    group = _free_name(loose.columns, "_group")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, now = None, None
        for batch in batches:
            own = batch.column(batch.schema.get_field_index(group)).to_numpy()
            for a, b in zip(*_runs(own), strict=True):
                if bins is None or own[a] != now:
                    now = own[a]
                    bins = Bins(capacity, open_bins, (1 << 62) + (int(now) << 32))
                part = batch.slice(a, b - a).select(made.names)
                at, off = _placed(bins, part.column(part.schema.get_field_index(length)).to_numpy())
                yield _with(part, [sequence, offset], **{sequence: at, offset: off})

    # Arrival by a hash of the first pass's place, so that a repeated task packs alike.
    order = _free_name([*loose.columns, group], "_order")
    dealt = loose.withColumn(order, F.xxhash64(sequence, offset)).withColumn(group, F.pmod(F.shiftright(order, 20), F.lit(groups)))
    dealt = dealt.repartition(group).sortWithinPartitions(group, order, sequence, offset).drop(order)
    return closed.unionByName(written(dealt.mapInArrow(again, out), "repacked"))


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Where runs of equal values begin and end."""
    new = np.flatnonzero(np.r_[True, values[1:] != values[:-1]][: len(values)])
    return new.tolist(), [*new[1:].tolist(), len(values)][: len(new)]


def _bytes_of_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """The ids of a byte-level BPE file of the ``tokenizers`` library, special strings being ordinary text.

    The file's merges are in the order of their ids, so its vocabulary serves as merge ranks and
    tiktoken gives the same ids some three times faster.  A text that it can't take (an extremely
    long run of white space) goes to ``tokenizers`` itself, as do all texts if the file differs.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.path, self._exact = path, None
        model, letters = made["model"], _bytes_of_letters()
        special = {t["content"] for t in made["added_tokens"]}
        merged = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
        self._fast = None
        if made["normalizer"] is None and made["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and merged == sorted(merged):
            ranks = {bytes(letters[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
            self._fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self._fast is not None:
            try:
                return np.array(self._fast.encode_ordinary(text), dtype="<u4")
            except BaseException as e:
                if type(e).__name__ != "PanicException":
                    raise
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_file(self.path)
            self._exact.encode_special_tokens = True
        return np.array(self._exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


def piece_bounds(n: int, capacity: int) -> list[int]:
    """Where the pieces of ``n`` tokens begin, and ``n``: all are of ``capacity`` but the first, which may be shorter."""
    first = n % capacity or min(n, capacity)
    return [0, *range(first, n + 1, capacity)]


def _cutter(tokenizer: str, capacity: int, end_id: int, key: T.StructField, digest: bool):
    """What cuts batches of (key, text) into pieces, and their schema; with ``digest``, ids are left as their CRC-32."""
    last = T.StructField("ids_crc32", T.LongType()) if digest else T.StructField("ids", T.BinaryType())
    schema = T.StructType([T.StructField(key.name, key.dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), last])
    names = schema.names

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[tuple] = []
                for i, x in enumerate(part.column(1).to_pylist()):
                    ids = np.append(encode(x or ""), np.uint32(end_id)).astype("<u4")
                    bounds = piece_bounds(len(ids), capacity)
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                        data = ids[a:b].tobytes()
                        rows.append((i, k, a, b - a, zlib.crc32(data) if digest else data))
                i, piece, start, length, data = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(i)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(data, pa.int64() if digest else pa.binary())],
                    names=names,
                )

    return cut, schema


def pieces(df: DataFrame, tokenizer: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (key, piece, start, length, ids) per piece of every text; ``ids`` are little-endian unsigned 32-bit."""
    return df.select(key, text).mapInArrow(*_cutter(tokenizer, capacity, end_id, df.schema[key], False))


def pack_texts(df: DataFrame, tokenizer: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """The pieces of every text with their sequence and offset, tokenised and placed in one pass."""
    return pack(df.select(key, text), "length", capacity, cut=_cutter(tokenizer, capacity, end_id, df.schema[key], digest))


def sequences(packed: DataFrame, sequence: str = "sequence_id", offset: str = "offset", ids: str = "ids") -> DataFrame:
    """The token sequences themselves: (sequence, ids, n_pieces) of packed pieces that carry their ids.

    A group is one sequence, so it holds ``capacity`` tokens at most.
    """
    parts = F.sort_array(F.collect_list(F.struct(F.col(offset).alias("o"), F.col(ids).alias("b"))))
    return packed.groupBy(sequence).agg(F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["b"])).alias(ids), F.count("*").alias("n_pieces"))
