"""A toxicity classifier: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's terms are its words (runs of letters, digits and bytes beyond ASCII, A-Z lower-cased), its
pairs of neighbours, its pairs with one word between, and the stems of its longer words (their first
``STEM`` bytes), each hashed to one of 2 ** ``BITS`` coordinates; a text has a coordinate or not.  Each coordinate learns at its own rate, and an L1
penalty keeps at zero those that tell little, so the weights are few and cheap to broadcast.

The model is fitted on the driver to a sample of at most ``LABELLED`` labelled rows with at most
``COORDINATES`` coordinates in all, chosen by a hash of the id and passed over ``EPOCHS`` times in the
order of another, so that reruns agree.  The stems and the penalty were chosen by cross-validation
on rows that may be learned from.

Nulls: a null text is empty, and scored by the bias alone.  Rows without a label are not learned
from; repeated ones count so often, as do rows of one id, each for itself.  Without labelled rows
every score is 0.5.  A very long text is hashed piece by piece.  An empty table gives no rows; a column
named like the score is replaced, other columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.bytetext import U64, counts_in, hashes, mix, slices, spans_of
from tidemill.llm.quality import labelled
from tidemill.scratch import written

BITS = 20
STEM = 7
LABELLED, COORDINATES = 12_000, 1 << 25
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 24.0, 0.1
#: How much more a toxic text's gradient counts, as such texts are the fewer.
POSITIVE = 6.0

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, coordinate) of every term, with repeats."""
    starts, ends = spans_of(_WORD[data], offsets)
    n = counts_in(starts, offsets)
    w = hashes(data, starts, ends)
    doc = np.repeat(np.arange(len(n)), n)
    docs, out = [doc], [w]
    for gap, salt in ((1, 0x2545F4914F6CDD1D), (2, 0x9FB21C651E98DF25)):
        same = doc[gap:] == doc[:-gap]
        docs.append(doc[:-gap][same])
        out.append(mix(w[:-gap][same] * U64(salt) + w[gap:][same]))
    long = ends - starts > STEM
    docs.append(doc[long])
    out.append(mix(hashes(data, starts, np.minimum(ends, starts + STEM))[long] ^ U64(0xA24BAED4963EE407)))
    return np.concatenate(docs), (np.concatenate(out) >> U64(64 - BITS)).astype(np.int64)


class Ftrl:
    """Weights in closed form from two sums per coordinate; the last coordinate is the bias, without a penalty."""

    def __init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(np.asarray(at) == 1 << BITS, 0.0, L1) if not isinstance(at, slice) else np.r_[np.full(1 << BITS, L1), 0.0]
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, y: float) -> None:
        at = np.append(at, 1 << BITS)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y) * (POSITIVE if y else 1.0)
        grown = np.sqrt(self.n[at] + g * g)
        self.z[at] += g - (grown - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] += g * g


def fit(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights, bias) of the model, with only the weights that are not zero."""
    model = Ftrl()
    for _ in range(EPOCHS):
        for at, label in zip(rows, y.tolist(), strict=True):
            model.learn(at, label)
    w = model.weights(slice(None))
    at = np.flatnonzero(w[:-1])
    return at, w[at], float(w[-1])


def scores(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    doc, at = terms(data, offsets)
    some = weights[at] != 0
    pairs = np.unique(doc[some] << BITS | at[some])
    total = np.bincount(pairs >> BITS, weights[pairs & (1 << BITS) - 1], len(offsets) - 1)
    return 1 / (1 + np.exp(-np.clip(total + bias, -35, 35)))


def learn(docs: DataFrame, labels: DataFrame, label: str, usable: Column, key: str = "doc_id", text: str = "text") -> tuple[np.ndarray, np.ndarray, float]:
    rows = labelled(docs.select(key, text), labels, label, usable, LABELLED, key)
    rows = rows.select(F.xxhash64(F.lit("order"), "_id").alias("_order"), "_id", "_label", F.col(text).alias("_text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "_text"):
            doc, at = terms(data, offsets)
            pairs = np.unique(doc << BITS | at)
            bounds = np.searchsorted(pairs >> BITS, np.arange(part.num_rows + 1))
            found = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array((pairs & (1 << BITS) - 1).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), found], names=["_order", "_id", "_label", "at"])

    rows = written(rows.mapInArrow(measure, "_order long, _id long, _label int, at array<int>"), "terms")
    keys = ["_order", "_id", "_label", "_size", "_hash"]
    rows = rows.withColumns({"_size": F.size("at"), "_hash": F.xxhash64("at")})
    # What is chosen are the first rows that fit into the bound; of them no more than their sizes is known here yet.
    sizes = rows.select(*keys).orderBy(*keys).limit(LABELLED).collect()
    n = int(np.searchsorted(np.cumsum([r["_size"] for r in sizes]), COORDINATES, side="right"))
    last = F.struct(*(F.lit(x).alias(k) for k, x in zip(keys, sizes[max(n - 1, 0)], strict=True))) if sizes else F.lit(None)
    found = rows.filter(F.struct(*keys) <= last).orderBy(*keys).limit(n).select("_order", "_id", "_label", "at").toArrow() if n else rows.limit(0).toArrow()
    y = found.column("_label").to_numpy()
    at = [x.values.to_numpy() for x in found.column("at")]
    # Rows that share an id and a label come in the order of their terms.
    order = sorted(range(len(y)), key=lambda i: (found.column("_order")[i].as_py(), found.column("_id")[i].as_py(), y[i], at[i].tobytes()))
    return fit([at[i] for i in order], y[order].astype(np.float64))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the model's score added or replaced, from 0 to 1."""
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(f.name, f.dataType, True) for f in docs.schema.fields] + [T.StructField(name, T.DoubleType())]
    names = [f.name for f in fields]

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, bias = shared.value
        weights = np.zeros(1 << BITS)
        weights[at] = values
        for part, data, offsets in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores(data, offsets, weights, bias))], names=names)

    return docs.mapInArrow(rate, T.StructType(fields))
