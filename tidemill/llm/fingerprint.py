"""One-permutation MinHash fingerprints, by DataFrame functions alone.

A text's shingles of ``WIDTH`` words are hashed once.  The top bits of a hash pick one of ``BINS``
bins, and each bin keeps its least hash: hashes are sorted together with one sentinel per bin that
ends it, so the firsts of the runs are the minima, and a sentinel marks an empty bin.  An empty bin
takes the value of the first full one on its own sequence of universal hashes over (bin, attempt),
which is optimal densification.  The sequence goes on until a full bin is met: its first ``ATTEMPTS``
steps are tried one by one, and what follows is the full bin of the least hash with this one, which
any of them is with the same chance.
The low ``BITS`` bits of the bins are stored, ``PER_WORD`` to a 64-bit word; ``likeness`` corrects the
share of equal ones for those that are equal by chance.

A text of fewer words has its whole sequence as its one shingle.  A null text is empty; an empty
text has the empty fingerprint, whose likeness is 1 to another empty one and 0 to all else.  A very long
text is hashed by one task in memory of some times its words.  Columns may have any names; one that is
named like an added one is replaced.

Neighbours follow the order of ids, null first; rows of one id that of a hash of their texts, and equal
rows follow one another.  So an id of very many rows spans many ranges; rows that are equal and very
many are counted, stand in the order once, and come apart again at the end.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.scratch import written

WIDTH = 5
BINS, BITS = 256, 8
ATTEMPTS = 48
PER_WORD = 64 // BITS
SPACES = " \t\n\x0b\x0c\r"
#: Rows per range of neighbours, about, and ranges at most, about.
RANGE_ROWS, MOST_RANGES = 64, 1 << 17
#: Equal rows are counted if there are more of them than this, and than an even share of so many.
EQUAL_ROWS, MOST_EQUAL = 1000, 10_000
_PRIME = 8191
_LOW = 64 - BINS.bit_length() + 1
_ENDS = (1 << _LOW) - 1
_NONE = -(1 << 63)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the text's runs of ``width`` words."""
    bare = F.btrim(text, F.lit(SPACES))
    words = F.transform(F.split(bare, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))
    runs = _let(
        words,
        lambda w: F.when(
            F.size(w) >= width,
            F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*(w[i + k] for k in range(width)))),
        ).otherwise(F.array(F.xxhash64(w, F.size(w)))),
    )
    return F.when(F.length(bare) > 0, runs).otherwise(F.array().cast("array<bigint>"))


def _bin(h: Column) -> Column:
    """0 to BINS - 1, rising with the hash."""
    return F.shiftright(h, _LOW) + BINS // 2


def _probe(i: Column, attempt: int) -> Column:
    a, b = 1 + 7919 * attempt % (_PRIME - 1), 104729 * attempt * attempt % _PRIME
    return ((i + 1) * a + b) % _PRIME % BINS


def _densified(v: Column) -> Column:
    """Every bin's value, from bins of which the empty ones are null."""

    def value(i: Column, full: Column) -> Column:
        tries = [F.get(v, _probe(i, t).cast("int")) for t in range(1, ATTEMPTS + 1)]
        later = F.array_min(F.transform(full, lambda b: F.struct(F.xxhash64(i, b["at"]).alias("turn"), b["x"].alias("x"))))["x"]
        return F.coalesce(F.get(v, i), *tries, later)

    full = F.filter(F.transform(v, lambda x, i: F.struct(i.alias("at"), x.alias("x"))), lambda b: b["x"].isNotNull())
    return _let(full, lambda f: F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: value(i, f)))


def _packed(full: Column) -> Column:
    """The low bits of the bins, PER_WORD to a word."""

    def word(g: Column) -> Column:
        out = None
        for k in range(PER_WORD):
            part = F.shiftleft(full[g * PER_WORD + k].bitwiseAND(F.lit((1 << BITS) - 1).cast("bigint")), BITS * k)
            out = part if out is None else out.bitwiseOR(part)
        return out

    return F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_WORD - 1)), word)


def _free(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the text's packed fingerprint, an array of words that is empty for a text without any."""
    ends = F.transform(F.sequence(F.lit(-BINS // 2), F.lit(BINS // 2 - 1)), lambda b: F.shiftleft(b.cast("bigint"), _LOW) + F.lit(_ENDS).cast("bigint"))
    hashes = _free(df, "__tidemill_hashes")
    sorted_ = df.withColumn(hashes, F.sort_array(F.concat(shingle_hashes(F.coalesce(F.col(text), F.lit(""))), ends)))
    firsts = _let(F.col(hashes), lambda s: F.filter(s, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(s, i - 1)))))
    full = lambda x: F.when(x.bitwiseAND(F.lit(_ENDS).cast("bigint")) != _ENDS, x)
    packed = _let(F.transform(firsts, full), lambda v: _let(_densified(v), _packed))
    empty = F.size(hashes) == BINS
    return sorted_.withColumn(name, F.when(empty, F.array().cast("array<bigint>")).otherwise(packed)).drop(hashes)


def as_hex(words: Column) -> Column:
    return F.lower(F.array_join(F.transform(words, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """The share of shingles that two texts have in common, estimated from packed fingerprints."""
    ones = F.lit(sum(1 << (BITS * k) for k in range(PER_WORD))).cast("bigint")

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        step = 1
        while step < BITS:
            d = d.bitwiseOR(F.shiftrightunsigned(d, step))
            step *= 2
        return F.bit_count(d.bitwiseAND(ones))

    apart = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-BITS
    share = ((BINS - apart) / BINS - chance) / (1 - chance)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def with_next(df: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """Add next_<column>: that of the next row in the ``order`` of some 64-bit columns without nulls; the first row's for the last.

    Rows are dealt into ranges, whose lower bounds are rows' own places that their hash picks; a range's
    first rows are also sent to the range before it, whose last row they follow.  So one shuffle
    suffices and no task orders more than a range, unless very many rows have one place.
    """
    place, bounds_, range_, guest, to = (_free(df, f"__tidemill_{x}") for x in ("place", "bounds", "range", "guest", "to"))
    keyed = df.withColumn(place, F.struct(*order))
    n, least = keyed.agg(F.count("*"), F.min(place)).first()
    every = max(RANGE_ROWS, n // MOST_RANGES)
    first = F.struct(*(F.lit(x).cast("bigint").alias(c) for c, x in zip(order, least, strict=True))) if n else F.lit(None)
    picked = keyed.filter((F.pmod(F.xxhash64(*order), F.lit(every)) == 0) | (F.col(place) == first))
    bounds = written(picked.agg(F.sort_array(F.collect_set(place)).alias("b")), "bounds").scalar()
    steps = F.array(*(F.lit(1 << s) for s in range(MOST_RANGES.bit_length(), -1, -1)))
    at = F.aggregate(steps, F.lit(0), lambda lo, s: F.when(F.get(F.col(bounds_), lo + s) <= F.col(place), lo + s).otherwise(lo))
    dealt = keyed.withColumn(bounds_, bounds).withColumn(range_, at)
    begins = F.get(F.col(bounds_), F.col(range_)) == F.col(place)
    here = F.struct(F.col(range_).alias("r"), F.lit(False).alias("g"))
    before = F.struct(F.pmod(F.col(range_) - 1, F.size(bounds_)).alias("r"), F.lit(True).alias("g"))
    dealt = dealt.withColumn(to, F.explode(F.when(begins, F.array(here, before)).otherwise(F.array(here))))
    dealt = dealt.select(*df.columns, F.col(f"{to}.r").alias(range_), F.col(f"{to}.g").alias(guest))
    follows = Window.partitionBy(range_).orderBy(guest, *order)
    led = dealt.withColumns({f"next_{c}": F.lead(c).over(follows) for c in columns})
    return led.filter(~F.col(guest)).drop(range_, guest)


def _counted(rows: DataFrame) -> DataFrame:
    """Rows (id, k, h, t) with how many they stand for: 1, or all of those with one k and h where these are very many.

    At most ``MOST_EQUAL`` different rows are so frequent, and they alone are broadcast.
    """
    n = rows.agg(F.count("*")).first()[0]
    frequent = rows.groupBy("k", "h").agg(F.count("*").alias("n")).filter(F.col("n") > max(EQUAL_ROWS, n // MOST_EQUAL))
    frequent = written(frequent.select("k", "h"), "frequent")
    if frequent.isEmpty():
        return rows.withColumn("n", F.lit(1).cast("bigint"))
    one = rows.join(F.broadcast(frequent), ["k", "h"], "left_anti").withColumn("n", F.lit(1).cast("bigint"))
    many = rows.join(F.broadcast(frequent), ["k", "h"], "left_semi").groupBy("k", "h").agg(F.first("id").alias("id"), F.first("t").alias("t"), F.count("*").alias("n"))
    return one.unionByName(many)


def edited_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) per document.

    ``edited`` is the text with its last quarter, rounded down, replaced by as many code points from
    the beginning of the next document, or all it has.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(key).cast("bigint"), F.lit(_NONE)).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = _counted(rows.withColumn("h", F.xxhash64("t")))
    led = with_next(with_fingerprint(rows, "t", "f"), ["k", "h"], ["t", "f"])
    # Of equal rows all but the last are followed by their like.
    itself = F.struct(F.col("t").alias("t"), F.col("f").alias("f"), (F.col("n") - 1).alias("n"))
    other = F.struct(F.col("next_t").alias("t"), F.col("next_f").alias("f"), F.lit(1).cast("bigint").alias("n"))
    led = led.withColumn("x", F.explode(F.when(F.col("n") > 1, F.array(itself, other)).otherwise(F.array(other))))
    led = led.select("id", "t", "f", F.col("x.t").alias("next_t"), F.col("x.f").alias("next_f"), F.col("x.n").alias("n"))
    n = F.length("t").cast("bigint")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("t"), F.lit(1), n.cast("int") - quarter), F.substring(F.col("next_t"), F.lit(1), quarter))
    led = with_fingerprint(led.select("id", "n", n.alias("n_chars"), edited.alias("edited"), "f", "next_f"), "edited", "g")
    out = led.select("id", "n", "n_chars", "edited", "f", "g", likeness(F.col("f"), F.col("g")).alias("near_edited"), likeness(F.col("f"), F.col("next_f")).alias("near_next"))
    some = F.sequence(F.lit(1).cast("bigint"), F.col("n"), F.lit(EQUAL_ROWS).cast("bigint"))
    out = out.withColumn("at", F.explode(some)).withColumn("at", F.explode(F.sequence(F.col("at"), F.least(F.col("n"), F.col("at") + (EQUAL_ROWS - 1)))))
    return out.select(F.col("id").alias(key), "n_chars", "edited", F.col("f").alias("fingerprint"), F.col("g").alias("edited_fingerprint"), "near_edited", "near_next")
