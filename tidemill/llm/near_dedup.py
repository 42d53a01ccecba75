"""Near-duplicate documents by banded MinHash, odd sketches and exact confirmation.

A document is the set of its word shingles.  Documents with equal sets are one class, compared once.

1. ``HASHES`` MinHash samples per document make ``BANDS`` bands of ``ROWS``; equal bands make a bucket.
   Two documents of Jaccard similarity 0.8 share no bucket with a probability of 1.2e-7.
2. The samples are also folded into an odd sketch: each toggles one of ``SKETCH`` bits.  The bits in
   which two sketches differ estimate a high similarity precisely; pairs whose estimate is ``SLACK``
   below the threshold, about five standard errors, or more are candidates.  A bucket of more than
   ``CHUNK`` members is dealt into chunks of about that size, and some ``PIVOTS`` of its members,
   picked by a hash, join every chunk: so a member is copied once, whatever the bucket's size.
3. A task reports, of a chunk's candidates, a forest that joins what they join.  The forest's pairs
   are confirmed on the full sets, and the links' components are found by alternating stars.  The
   pivots make a bucket of near copies one component.
4. What is still apart is compared where it may yet be joined.  In a chunk with further candidates,
   members of different components are; and in a bucket of several chunks, those that are not in its
   largest component meet all the others, in blocks of about ``MEET`` of either.  Members with
   candidates in another component get their full sets, and the task confirms them in place, each
   pair in the first bucket that it shares; so that no link that joins components is lost, and no
   more than a forest of links leaves a task.

Work and copies grow with the square of a bucket only in so far as its members are neither linked
nor apart by their bands: m members of which r lie outside the largest component make about
m * r / MEET further copies, and r * m comparisons of sketches.

Full sets are made only for documents in candidate pairs: a Bloom filter of their ids, of bounded
size, goes to the scan of the texts.

Nulls: a null text is empty; an empty set links with nothing.  Each row of a repeated id is
compared by its own text, and links that reach one of its texts reach all; one without words stands
alone.  Sketches, bands and sets are joined by id and digest of the set, so that work and copies grow in
proportion to the texts of an id, however many.  A null id comes first in order, and is null again in the result.  A very long text is hashed
piece by piece and held once with its set.  Repeated rows and equal texts are one class, compared
once.  An empty table gives no rows.  Of further columns, whatever their names, none is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import bloom
from tidemill.llm.bytetext import U64, counts_in, hashes, mix, shingles, signed, slices, words
from tidemill.llm.components import components
from tidemill.scratch import written

WIDTH = 5
PERCENT = 80
ROWS, BANDS = 5, 40
HASHES = ROWS * BANDS
SKETCH = 1024
SLACK = 0.15
CHUNK, PIVOTS, MEET = 256, 16, 512
#: Groups of chunks that meet are numbered from here, apart from the chunks themselves.
APART = 1 << 32
FILTER_BYTES = 1 << 25
#: What tells one text's set from others: its id and its digest, as many texts may have one id.
KEY = ["id", "a"]
_NONE = -(1 << 63)
_A = mix(np.arange(1, HASHES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_B = mix(np.arange(1, HASHES + 1, dtype=U64) * U64(0xC2B2AE3D27D4EB4F))


def sets_of(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted within it, and how many each has."""
    starts, ends = words(data, offsets)
    found, n = shingles(hashes(data, starts, ends), counts_in(starts, offsets), width)
    bounds = np.r_[0, np.cumsum(n)]
    out = [np.unique(found[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    return (np.concatenate(out) if out else found), np.array([len(x) for x in out], dtype=np.int64)


def samples(flat: np.ndarray, n: np.ndarray) -> np.ndarray:
    """MinHash samples, a row per text that has a set."""
    full = n[n > 0]
    out = np.empty((HASHES, len(full)), dtype=U64)
    bounds = np.cumsum(full) - full
    # Some texts at a time, so that a hash function's values stay in the cache.
    at = 0
    while at < len(full):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + (1 << 15), side="right")) - 1) if at + 1 < len(full) else len(full)
        part = flat[bounds[at] : bounds[to] if to < len(full) else len(flat)]
        here, value = bounds[at:to] - bounds[at], np.empty_like(part)
        for k in range(HASHES):
            np.multiply(part, _A[k], out=value)
            np.add(value, _B[k], out=value)
            out[k, at:to] = np.minimum.reduceat(value, here)
        at = to
    return out.T


def band_hashes(sampled: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sampled), BANDS), dtype=U64)
    for r in range(ROWS):
        out = mix(out + sampled[:, r::ROWS])
    return out


def odd_sketches(sampled: np.ndarray) -> np.ndarray:
    """A row of SKETCH / 8 bytes per row of samples: each sample toggles one bit."""
    bit = (mix(sampled ^ _B) >> U64(64 - SKETCH.bit_length() + 1)).astype(np.int64)
    flat = bit + np.arange(len(sampled))[:, None] * SKETCH
    odd = np.bincount(flat.ravel(), minlength=len(sampled) * SKETCH) & 1
    return np.packbits(odd.reshape(-1, SKETCH).astype(np.uint8), axis=1)


def bits_apart(similarity: float) -> int:
    """In how many bits two sketches differ, at most, whose estimated similarity is that or more."""
    return int(SKETCH / 2 * (1 - np.exp(-4 * HASHES * (1 - similarity) / SKETCH)))


def _digest(flat: np.ndarray, n: np.ndarray, seed: int = 0) -> np.ndarray:
    """A sum over each set that is not empty, whatever its order; the same for equal sets."""
    some = n > 0
    out = np.zeros(len(n), dtype=U64)
    if some.any():
        out[some] = np.add.reduceat(mix(flat ^ U64(seed)), (np.cumsum(n) - n)[some])
    return out


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    schema = "id long, n long, a long, b long, bands array<long>, sketch binary"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "t"):
            flat, n = sets_of(data, offsets, width)
            some = n > 0
            digest = _digest(flat, n), _digest(flat, n, 0xD6E8FEB86659FD93)
            bands, sketch = [None] * len(n), [None] * len(n)
            if some.any():
                sampled = samples(flat, n)
                for i, x, y in zip(np.flatnonzero(some).tolist(), signed(band_hashes(sampled)), odd_sketches(sampled), strict=True):
                    bands[i], sketch[i] = x, y.tobytes()
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n), pa.array(signed(digest[0])), pa.array(signed(digest[1])), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                names=["id", "n", "a", "b", "bands", "sketch"],
            )

    return written(docs.mapInArrow(sign, schema), "signatures")


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what a symmetric matrix of near pairs joins, from the first row of each part."""
    left, out = np.ones(len(near), dtype=bool), []
    for root in range(len(near)):
        if not left[root]:
            continue
        left[root] = False
        todo = [root]
        while todo:
            v = todo.pop()
            found = np.flatnonzero(near[v] & left)
            left[found] = False
            out += [(v, w) for w in found.tolist()]
            todo += found.tolist()
    return out


class _Group:
    """The members of one chunk of a bucket, or of two sides that meet, by id."""

    def __init__(self, table: pa.Table):
        column = {n: table.column(n) for n in table.column_names}
        order = np.argsort(column["id"].to_numpy(), kind="stable")
        self.rows = table.take(pa.array(order))
        self.ids, self.sets, self.chunk = (column[c].to_numpy()[order] for c in ("id", "a", "chunk"))
        self.bits = np.frombuffer(b"".join(column["sketch"].to_pylist()), dtype=np.uint64).reshape(-1, SKETCH // 64)[order]
        self.two = column["j"][0].as_py() >= APART

    def near(self, i: int, most: int) -> np.ndarray:
        """Which of the members after the i-th are near it by their sketches; of two sides, those on the other."""
        ok = np.bitwise_count(self.bits[i + 1 :] ^ self.bits[i]).sum(axis=1, dtype=np.int64) <= most
        return ok & (self.chunk[i + 1 :] != self.chunk[i]) if self.two else ok


class _Marked(_Group):
    """A group whose members also have their component and their bands."""

    def __init__(self, table: pa.Table):
        super().__init__(table)
        self.part, self.pos = self.rows.column("part").to_numpy().copy(), self.rows.column("pos")[0].as_py()
        self.bands = np.stack([x.values.to_numpy() for x in self.rows.column("bands").combine_chunks()])

    def across(self, i: int, most: int) -> np.ndarray:
        """The later members near the i-th, in another component, that share no earlier band with it."""
        at = i + 1 + np.flatnonzero(self.near(i, most) & (self.part[i + 1 :] != self.part[i]))
        return at[np.argmax(self.bands[at] == self.bands[i], axis=1) == self.pos] if len(at) else at


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Runs of whole groups of rows sorted by bucket, i and j, with the groups' bounds."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        key = [table.column(k).to_numpy() for k in ("bucket", "i", "j")]
        new = np.flatnonzero(np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in key])])
        if len(new) > 1:
            yield table.slice(0, new[-1]), new
        held = table.slice(new[-1]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.array([0, table.num_rows])


def _members(reps: DataFrame) -> DataFrame:
    """(bucket, m, i, j, chunk, home, pos, id, a, sketch): every member at home in a chunk of each bucket, pivots in all its chunks."""
    banded = reps.select(*KEY, F.posexplode("bands").alias("pos", "band")).select(F.xxhash64("pos", "band").alias("bucket"), "pos", *KEY)
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    chunks = F.ceil(F.col("m") / CHUNK)
    own = F.pmod(F.xxhash64(*KEY), chunks)
    pivot = (chunks > 1) & (F.pmod(F.xxhash64("bucket", *KEY), F.col("m")) < PIVOTS)
    every = F.sequence(F.lit(0).cast("long"), chunks - 1)
    dealt = banded.join(sizes, "bucket").join(reps.select(*KEY, "sketch"), KEY).withColumn("own", own)
    dealt = dealt.withColumn("i", F.explode(F.when(pivot, every).otherwise(F.array("own"))))
    return dealt.select("bucket", "m", "i", F.col("i").alias("j"), F.lit(0).alias("chunk"), (F.col("i") == F.col("own")).alias("home"), "pos", *KEY, "sketch")


def _meetings(members: DataFrame, parts: DataFrame) -> DataFrame:
    """(bucket, i, j, chunk, pos, id, a, part, sketch): in buckets of several chunks, what lies outside the largest component meets all the rest.

    Nothing is joined by bucket alone, so that a bucket of very many members needs no task of its own.
    """
    own = members.filter((F.col("m") > CHUNK) & F.col("home")).select("bucket", "m", "i", "pos", *KEY, "sketch").join(parts, "id", "left")
    own = own.withColumn("part", F.coalesce("component", "id"))
    largest = own.groupBy("bucket", "m", "part").agg(F.count("*").alias("n")).groupBy("bucket", "m").agg(F.max(F.struct("n", "part")).alias("top"))
    largest = largest.filter("m > top.n").select("bucket", F.col("top.part").alias("main"), (F.col("m") - F.col("top.n")).alias("r"), F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("m") / CHUNK) - 1)).alias("i"))
    own = own.join(largest, ["bucket", "i"])
    several = CHUNK * max(1, MEET // CHUNK)
    hosts, guests = F.ceil(F.col("m") / several), F.ceil(F.col("r") / MEET)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    rest = ["pos", *KEY, "part", "sketch"]
    at_home = own.select("bucket", F.pmod("i", hosts).alias("i"), upto(guests).alias("k"), F.lit(0).alias("chunk"), *rest)
    visiting = own.filter("part <> main").select("bucket", upto(hosts).alias("i"), F.pmod(F.xxhash64(*KEY, F.lit(1)), guests).alias("k"), F.lit(1).alias("chunk"), *rest)
    return at_home.unionByName(visiting).select("bucket", "i", (F.col("k") + APART).alias("j"), "chunk", *rest)


def _by_group(members: DataFrame) -> DataFrame:
    keys = ["bucket", "i", "j"]
    return members.repartition(*keys).sortWithinPartitions(*keys)


def _forests(members: DataFrame, most: int) -> DataFrame:
    """Pairs (x, xa, y, ya) of forests that join what candidates join; and (bucket, i, j) of groups with further candidates."""
    names = ["x", "xa", "y", "ya", "bucket", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _grouped(batches):
            keys = np.stack([table.column(c).to_numpy() for c in KEY])
            bits = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint64).reshape(-1, SKETCH // 64)
            size = np.diff(bounds)
            # Groups of two, the most frequent by far, at once.
            at = bounds[:-1][size == 2]
            at = at[np.bitwise_count(bits[at] ^ bits[at + 1]).sum(axis=1, dtype=np.int64) <= most]
            pairs, more = [np.concatenate([keys[:, at], keys[:, at + 1]])], []
            for a, n in zip(bounds[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
                group = _Group(table.slice(a, n))
                near = np.zeros((n, n), dtype=bool)
                for i in range(n - 1):
                    near[i, i + 1 :] = near[i + 1 :, i] = group.near(i, most)
                forest = np.array(_forest(near), dtype=np.int64).reshape(-1, 2)
                pairs.append(np.concatenate([[group.ids[k], group.sets[k]] for k in forest.T]))
                if near.sum() > 2 * len(forest):
                    more.append([table.column(k)[a].as_py() for k in ("bucket", "i", "j")])
            # Texts of one id are one document: they need no link.  The smaller id comes first.
            found = np.concatenate(pairs, axis=1)
            found = found[:, found[0] != found[2]]
            found = np.where(found[0] < found[2], found, found[[2, 3, 0, 1]])
            rows = [*(pa.array(c) for c in found), *[pa.nulls(found.shape[1], pa.int64())] * 3]
            yield pa.RecordBatch.from_arrays(rows, names=names)
            if more:
                yield pa.RecordBatch.from_arrays([*[pa.nulls(len(more), pa.int64())] * 4, *(pa.array(c) for c in zip(*more, strict=True))], names=names)

    rows = members.select("bucket", "i", "j", "chunk", *KEY, "sketch")
    return written(_by_group(rows).mapInArrow(compare, "x long, xa long, y long, ya long, bucket long, i long, j long"), "forests")


def _sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, a, s): the full sets of these ids' texts, each once; a few others may be among them."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom.of(ids, "id", FILTER_BYTES))

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = (b.filter(pa.array(bloom.holds(*shared.value, b.column(0).to_numpy()))) for b in batches if b.num_rows)
        for rows, data, offsets in slices(wanted, "t"):
            flat, n = sets_of(data, offsets, width)
            # Sorted as signed numbers, as they are kept.
            sets = [np.sort(signed(x)) for x in np.split(flat, np.cumsum(n)[:-1])]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(signed(_digest(flat, n))), pa.array(sets, pa.list_(pa.int64()))], names=[*KEY, "s"])

    out = written(docs.mapInArrow(full, "id long, a long, s array<long>"), "sets")
    # Only where rows are repeated are the sets shuffled once more, to be there once.
    if out.groupBy(*KEY).count().filter("count > 1").isEmpty():
        return out
    return written(out.dropDuplicates(KEY), "sets")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) of (x, xa, y, ya) whose full sets are similar enough; those of several texts may come repeatedly.

    Nothing after the joins needs a key's rows together, so a first document of very many pairs can
    be split among tasks.
    """
    first = sets.select(F.col("id").alias("x"), F.col("a").alias("xa"), "s")
    second = sets.select(F.col("id").alias("y"), F.col("a").alias("ya"), F.col("s").alias("t"))
    both = pairs.join(second, ["y", "ya"]).join(first, ["x", "xa"])
    common = F.size(F.array_intersect("s", "t")).cast("long")
    both = both.select("x", "y", common.alias("c"), (F.size("s").cast("long") + F.size("t") - common).alias("u"))
    return both.filter((F.col("c") * 100 >= F.col("u") * percent) & (F.col("c") > 0)).select("x", "y")


def _apart(members: DataFrame, forests: DataFrame, parts: DataFrame) -> DataFrame:
    """The members, with their component, of the chunks that have further candidates and hold several components."""
    further = members.join(forests.filter("bucket is not null").select("bucket", "i", "j").distinct(), ["bucket", "i", "j"], "left_semi")
    own = further.join(parts, "id", "left").withColumn("part", F.coalesce("component", "id"))
    several = own.groupBy("bucket", "i", "j").agg(F.min("part").alias("a"), F.max("part").alias("b")).filter("a < b")
    return own.join(several.select("bucket", "i", "j"), ["bucket", "i", "j"], "left_semi").select("bucket", "i", "j", "chunk", "pos", *KEY, "part", "sketch")


def _links_across(groups: DataFrame, reps: DataFrame, sets: DataFrame, docs: DataFrame, width: int, most: int, percent: int) -> DataFrame:
    """Links (x, y) between components, confirmed in the tasks that compare the groups.

    First the members are found that have a candidate in another component; their sets follow.
    """
    marked = groups.join(reps.select(*KEY, "bands"), KEY)
    columns = ["bucket", "i", "j", "chunk", "pos", *KEY, "part", "sketch", "bands"]
    schema = "bucket long, i long, j long, chunk int, pos int, id long, a long, part long, sketch binary, bands array<long>"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _grouped(batches):
            for a, b in zip(bounds, bounds[1:], strict=False):
                group, has = _Marked(table.slice(a, b - a)), np.zeros(b - a, dtype=bool)
                for i in range(b - a - 1):
                    at = group.across(i, most)
                    has[at], has[i] = True, has[i] or len(at) > 0
                if has.any():
                    yield from group.rows.filter(pa.array(has)).to_batches()

    some = written(_by_group(marked.select(*columns)).mapInArrow(find, schema), "across")
    missing = written(some.select(*KEY).distinct().join(sets, KEY, "left_anti"), "missing")
    if not missing.isEmpty():
        known = sets.select(*KEY)
        sets = sets.unionByName(_sets(docs, missing, width).join(known, KEY, "left_anti"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _grouped(batches):
            out: list[tuple[int, int]] = []
            for a, b in zip(bounds, bounds[1:], strict=False):
                group = _Marked(table.slice(a, b - a))
                sets_ = [x.values.to_numpy() for x in group.rows.column("s").combine_chunks()]
                for i in range(b - a - 1):
                    at, own = group.across(i, most), sets_[i]
                    if not len(at):
                        continue
                    n = np.array([len(sets_[k]) for k in at])
                    flat = np.concatenate([sets_[k] for k in at])
                    hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
                    common = np.add.reduceat(hit.astype(np.int64), np.cumsum(n) - n)
                    for k in at[common * 100 >= (n + len(own) - common) * percent].tolist():
                        if group.part[k] != group.part[i]:
                            out.append((int(group.ids[i]), int(group.ids[k])))
                            group.part[group.part == group.part[k]] = group.part[i]
            x, y = np.array(out, dtype=np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])

    return _by_group(some.join(sets, KEY).select(*columns, "s")).mapInArrow(confirm, "x long, y long").distinct()


def _same_ids(signatures: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (x, y) of repeated ids to the classes of all their texts."""
    full = signatures.filter("n > 0")
    several = full.groupBy("id").agg(F.min(F.struct("n", "a", "b")).alias("p"), F.max(F.struct("n", "a", "b")).alias("q")).filter("p <> q").select("id")
    return full.join(several, "id", "left_semi").join(classes, ["n", "a", "b"]).select(F.col("rep").alias("x"), F.col("id").alias("y")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) per row; component_id is the smallest key that links reach."""
    own = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NONE)).alias("id"), F.col(text).alias("t"))
    signed_ = _signatures(own, width)
    classes = written(signed_.filter("n > 0").groupBy("n", "a", "b").agg(F.min("id").alias("rep")), "classes")
    reps = signed_.filter("n > 0").join(classes.withColumnRenamed("rep", "id"), ["n", "a", "b", "id"], "left_semi").dropDuplicates(["n", "a", "b", "id"])
    reps = written(reps.select(*KEY, "bands", "sketch"), "reps")
    members = written(_members(reps), "members")

    most = bits_apart(percent / 100 - SLACK)
    forests = _forests(members, most)
    tried = written(forests.filter("x is not null").select("x", "xa", "y", "ya").distinct(), "candidates")
    sets = _sets(own, tried.select(F.explode(F.array("x", "y")).alias("id")).distinct(), width)
    links = written(_links(tried, sets, percent).unionByName(_same_ids(signed_, classes)), "links")
    found = components(links, "x", "y")
    parts = found.select(F.col("v").alias("id"), "component")
    groups = written(_apart(members, forests, parts).unionByName(_meetings(members, parts)), "groups")
    more = written(_links_across(groups, reps, sets, own, width, most, percent), "links")
    if not more.isEmpty():
        found = components(links.unionByName(more), "x", "y")

    named = classes.join(found.select(F.col("v").alias("rep"), "component"), "rep", "left").select("n", "a", "b", F.coalesce("component", "rep").alias("c"))
    out = signed_.select("id", "n", "a", "b").join(named, ["n", "a", "b"], "left").select("id", "n", F.coalesce("c", "id").alias("c"))
    real = lambda c: F.when(F.col(c) != _NONE, F.col(c))
    return out.select(real("id").alias(key), F.col("n").alias("n_shingles"), real("c").alias("component_id"), (F.col("id") == F.col("c")).alias("kept"))
