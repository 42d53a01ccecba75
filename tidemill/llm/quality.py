"""A quality classifier: a generalised additive model with pairwise interactions.

Features of a text's form are cut into bins.  Boosting goes round the features, again and again; at
each turn a shallow tree over one feature's bins is fitted to the residuals and added, at a small
rate, to that feature's lookup table.  The pairs of features whose coarse bins explain most of what
then remains get tables of their own, boosted alike.  A score is the logistic of a sum of table
entries: a text costs its features, one search per feature and vectorised additions.

The model is fitted on the driver to a sample of at most ``LABELLED`` labelled rows, of which it sees
the features alone.  The sample is chosen by a hash of the id, so it is the same in every run.

Nulls: a null text is empty, and scored like any text.  Rows without a label are not learned from;
repeated ones count so often, as do rows of one id, each for itself, up to ``LABELLED`` rows in all.
Without labelled rows of both kinds every score is their mean, or 0.5 if there are none.  A very long
text is measured by one task in memory of a few times its size.  An empty table gives no rows; a
column named like the score is replaced, other columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.bytetext import SPACE, counts_in, hashes, shingles, slices, words

LABELLED = 20_000
BINS, COARSE = 32, 6
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 6
RATE, SHRINK = 0.1, 5.0

_UPPER, _DIGIT, _LETTER, _WIDE = (np.zeros(256, dtype=bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_LETTER[65:91] = _LETTER[97:123] = True
_WIDE[128:] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[33:127] = True
_MARK &= ~(_LETTER | _DIGIT)
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,;:'\"-?()"]] = True

FEATURES = (
    "log_bytes", "log_words", "bytes_per_word", "upper", "digit", "mark", "odd_mark", "wide", "space", "mark_runs",
    "words_per_line", "distinct_words", "distinct_runs", "distinct_lines", "plain_words", "sentence_marks",
)


def _distinct(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many distinct values each text has."""
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((values, doc))
    v, d = values[order], doc[order]
    new = np.r_[True, (v[1:] != v[:-1]) | (d[1:] != d[:-1])] if len(v) else np.zeros(0, bool)
    return np.bincount(d[new], minlength=len(n))


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES per text; ratios of nothing are 0."""

    def each(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(mask), offsets))

    def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)

    size = np.diff(offsets)
    starts, ends = words(data, offsets)
    n = counts_in(starts, offsets)
    hashed = hashes(data, starts, ends)
    runs, n_runs = shingles(hashed, n, 3)
    mark, letter = _MARK[data], _LETTER[data] | _WIDE[data]
    doubled = np.zeros(len(data), dtype=bool)
    doubled[1:] = mark[1:] & (data[1:] == data[:-1])
    breaks = np.flatnonzero(data == 10)
    lines = np.diff(np.searchsorted(breaks, offsets)) + 1
    # A line is known by the sum of its words' hashes.
    line_of = np.searchsorted(breaks, starts) + np.repeat(np.arange(len(n)), n)
    total_lines = int(len(breaks) + len(n))
    line_sum = np.zeros(total_lines, dtype=np.uint64)
    np.add.at(line_sum, line_of, hashed)
    plain = each_in(letter, starts, ends) == ends - starts
    doc = np.repeat(np.arange(len(n)), n)
    plain_words = np.bincount(doc[plain], minlength=len(n))
    return np.stack(
        [
            np.log1p(size), np.log1p(n), share(size, n), share(each(_UPPER[data]), each(_LETTER[data])), share(each(_DIGIT[data]), size), share(each(mark), size),
            share(each(mark & ~_STOP[data]), size), share(each(_WIDE[data]), size), share(each(SPACE[data]), size), share(each(doubled), n),
            share(n, lines), share(_distinct(hashed, n), n), share(_distinct(runs, n_runs), n_runs), share(_distinct(line_sum, lines), lines), share(plain_words, n), share(each(_STOP[data]), n),
        ],
        axis=1,
    )


def each_in(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(mask)
    return np.searchsorted(at, ends) - np.searchsorted(at, starts)


@dataclass
class Model:
    """Cut points and a lookup table per feature, and a table per chosen pair over coarser bins."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        bins = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(self.cuts)]
        for b, table in zip(bins, self.tables, strict=True):
            total += table[b]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1 / (1 + np.exp(-total))


def _cut_gain(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best cut of bins with these gradient and weight sums: (gain, bins on the left)."""
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(a):
        return 0.0, 0
    gain = a**2 / (b + SHRINK) + (g.sum() - a) ** 2 / (h.sum() - b + SHRINK) - g.sum() ** 2 / (h.sum() + SHRINK)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """A shallow tree over bins in order: the step of each bin."""
    gain, at = _cut_gain(g, h)
    if depth == 0 or gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + SHRINK))
    return np.r_[_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)]


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree over a grid: the better axis is cut, then each side along the other; (gain, steps)."""
    best = (-1.0, np.zeros_like(g))
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        _, at = _cut_gain(a.sum(1), b.sum(1))
        if not at:
            continue
        out, gain = np.zeros_like(a), -a.sum() ** 2 / (b.sum() + SHRINK)
        for rows in (slice(0, at), slice(at, None)):
            p, q = a[rows].sum(0), b[rows].sum(0)
            out[rows] = _tree(p, q, 1)
            cut = _cut_gain(p, q)[1]
            gain += sum(p[s].sum() ** 2 / (q[s].sum() + SHRINK) for s in (slice(0, cut), slice(cut, None)))
        if gain > best[0]:
            best = (float(gain), out.T if flip else out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    if len(y) == 0 or y.min() == y.max():
        mean = y.mean() if len(y) else 0.5
        return Model(float(np.log((mean + 1e-6) / (1 - mean + 1e-6))))
    model = Model(float(np.log(y.mean() / (1 - y.mean()))))
    bins = []
    for k in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1]))
        model.cuts.append(cuts)
        model.tables.append(np.zeros(len(cuts) + 1))
        model.coarse.append(np.arange(len(cuts) + 1) * COARSE // (len(cuts) + 1))
        bins.append(np.searchsorted(cuts, x[:, k], side="right"))
    total = np.full(len(y), model.base)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for b, table in zip(bins, model.tables, strict=True):
            r, w = residual()
            step = RATE * _tree(np.bincount(b, r, len(table)), np.bincount(b, w, len(table)))
            table += step
            total += step[b]

    rough = [c[b] for c, b in zip(model.coarse, bins, strict=True)]
    grid = lambda i, j, v: np.bincount(rough[i] * COARSE + rough[j], v, COARSE**2).reshape(COARSE, COARSE)
    r, w = residual()
    gains = [(_pair_tree(grid(i, j, r), grid(i, j, w))[0], i, j) for i in range(len(bins)) for j in range(i)]
    model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    model.pair_tables = [np.zeros((COARSE, COARSE)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            r, w = residual()
            step = RATE * _pair_tree(grid(i, j, r), grid(i, j, w))[1]
            table += step
            total += step[rough[i], rough[j]]
    return model


def labelled(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: int, key: str = "doc_id") -> DataFrame:
    """Documents with their ``label``, for a bounded choice of usable labels.

    What is broadcast are ``most`` rows of an id and a label.
    """
    some = labels.filter(usable & F.col(key).isNotNull() & F.col(label).isin(0, 1)).select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label"))
    chosen = some.orderBy(F.xxhash64("_id"), "_id", "_label").limit(most)
    return docs.join(F.broadcast(chosen), docs[key] == F.col("_id"))


def learn(docs: DataFrame, labels: DataFrame, label: str, usable: Column, key: str = "doc_id", text: str = "text") -> Model:
    """A model of ``label`` from the usable labels' documents."""
    rows = labelled(docs.select(key, text), labels, label, usable, LABELLED, key).select("_id", "_label", F.col(text).alias("_text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "_text"):
            x = features(data, offsets)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["_id", "_label", "x"])

    # In one order, so that reruns agree.
    measured = rows.mapInArrow(measure, "_id long, _label int, x array<double>")
    found = measured.orderBy(F.xxhash64("_id"), "_id", "_label", "x").limit(LABELLED).toArrow()
    x = np.array(found.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    order = np.lexsort((*x.T[::-1], found.column("_label").to_numpy(), found.column("_id").to_numpy()))
    return fit(x[order], found.column("_label").to_numpy()[order].astype(np.float64))


def score(docs: DataFrame, model: Model, name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the model's score added or replaced, from 0 to 1."""
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(f.name, f.dataType, True) for f in docs.schema.fields] + [T.StructField(name, T.DoubleType())]
    names = [f.name for f in fields]

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shared.value.score(features(data, offsets)))], names=names)

    return docs.mapInArrow(rate, T.StructType(fields))
