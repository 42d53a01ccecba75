"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, how often the mix takes it.  Among all rates that meet each source's
token target and stop at ``MOST``, those nearest to 1 in relative entropy are exponentially tilted:
min(MOST, exp(lambda * size)), lambda being the source's multiplier in the convex dual.  Newton's
method finds the multipliers of all sources at once, each iteration one distributed aggregation
over counts of the distinct (source, size) pairs; a bracket catches steps that leave it, and sources
that do not settle raise an error.  Rates are then rounded into whole copies in blocks of about
``BLOCK_ROWS`` rows, along falling sizes, each row taking up what the larger ones before it left over,
so that a block's error is about half of its smallest document.  Equal rows are counted before they
are dealt into blocks, take their copies together, and come apart again at the end, some at a time:
so an id or a text that very many rows share fills no block.

All sums are over integers, so reruns agree to the last bit.  Only DataFrame functions are used.

Nulls: a null text has size 0, the null source is a source of its own, last in order; a document of
size 0 is copied once.  Repeated rows are documents of their own, and so are rows of one id; their
copies differ by one at most where they are equal.  A very long text is counted like any.  An empty
table gives no rows.  The input's columns may have any names; among ``carry``, one that is named like
a column of the result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.scratch import written

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3
WEIGHTS = (1, 2, 3)
BLOCK_ROWS = 256
ITERATIONS = 100
#: Equal rows that come apart at a time.
APART = 1 << 16
#: Sums are of multiples of 1 / UNIT words.
UNIT = 1024
NEAR = 1e-7
#: Names beside the input's own columns.
KEY, COPIES = "__tidemill_key", "__tidemill_copies"
RESULT = ("size", "source_size", "target", "rate", "copies")


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, source: str) -> DataFrame:
    """(sid, source, source_size, n_docs, least, target) from (source, size, n) counts.

    Weights repeat along the sources by code point, null last.  A target stops at MOST times its
    source's size; the excess is shared again by weight among the others: in the order of
    cap / weight, the sources that are capped come first, so running sums tell the level at which
    the rest stand.  One task sees one row per source here.
    """
    own = sizes.groupBy(source).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    ranked = own.withColumn("sid", F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("sid") - 1) % len(WEIGHTS) + 1)
    ranked = ranked.withColumn("_w", weight.cast("long")).withColumn("_cap", F.col("source_size") * MOST).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    every = Window.partitionBy()
    before = Window.orderBy("_ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    level = left / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
    ranked = ranked.withColumn("_level", level).withColumn("_capped", F.col("_ratio") <= F.col("_level"))
    stands = F.coalesce(F.max(F.when(~F.col("_capped"), F.col("_level"))).over(every), F.lit(0.0))
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(stands * F.col("_w"))
    return ranked.withColumn("target", target).select("sid", source, "source_size", "n_docs", "least", "target")


def rate(size: Column, multiplier: Column) -> Column:
    return F.least(F.lit(float(MOST)), F.exp(F.least(multiplier * size, F.lit(2.0))))


def multipliers(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """(sid, lam) for (sid, size, n) counts; null where the target is all the source can give, or nothing."""
    share = F.col("target") / F.col("source_size")
    solvable = (F.col("target") > 0) & (share < MOST * (1 - 1e-12))
    state = sources.filter(solvable).select(
        "sid", "target", F.lit(0.0).alias("lam"),
        F.least(F.lit(0.0), F.log(share) / F.col("least")).alias("lo"), (F.log(F.lit(float(MOST))) / F.col("least")).alias("hi"), F.lit(False).alias("done"),
    )
    state = written(state, "dual")
    exact = lambda x: F.sum(F.round(x * UNIT).cast("decimal(38,0)")).cast("double") / UNIT
    for turn in range(ITERATIONS + 1):
        if (left := state.filter(~F.col("done")).select("sid").take(5)) == []:
            break
        if turn == ITERATIONS:
            raise RuntimeError(f"sources have not settled after {ITERATIONS} iterations, among them number {[r['sid'] for r in left]}")
        r = rate(F.col("size"), F.col("lam"))
        tokens = F.col("n") * F.col("size") * r
        slope = F.when(r < MOST, tokens * F.col("size")).otherwise(0.0)
        seen = sizes.join(state.filter(~F.col("done")), "sid").groupBy("sid", "target", "lam", "lo", "hi").agg(exact(tokens).alias("g"), exact(slope).alias("h"))
        off = F.col("g") - F.col("target")
        lo, hi = F.when(off < 0, F.col("lam")).otherwise(F.col("lo")), F.when(off > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.try_divide(off, F.col("h"))
        done = F.abs(off) <= F.greatest(F.col("target") * NEAR, F.lit(0.5))
        step = F.when(done, F.col("lam")).when((newton > F.col("_lo")) & (newton < F.col("_hi")), newton).otherwise((F.col("_lo") + F.col("_hi")) / 2)
        moved = seen.withColumns({"_lo": lo, "_hi": hi}).select("sid", "target", step.alias("lam"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), done.alias("done"))
        state = written(state.filter(F.col("done")).unionByName(moved), "dual")
    return state.select("sid", "lam")


def _copies(items: Column) -> Column:
    """Copies of all rows of items (size, rate, n, ...) by falling size, carrying on what rounding left over."""
    start = F.struct(F.lit(0.0).alias("over"), F.array().cast("array<bigint>").alias("copies"))

    def step(state: Column, x: Column) -> Column:
        want = state["over"] + x["rate"] * x["size"] * x["n"]
        n = F.when(x["size"] == 0, x["n"]).otherwise(F.greatest(F.lit(0).cast("bigint"), F.least(x["n"] * MOST, F.round(F.try_divide(want, x["size"])).cast("bigint"))))
        return F.struct((want - n * x["size"]).alias("over"), F.concat(state["copies"], F.array(n)).alias("copies"))

    return F.aggregate(items, start, step, lambda s: s["copies"])


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row (key, *carry, size, source_size, target, rate, copies) per document."""
    carry = tuple(c for c in carry if c.lower() not in {key.lower(), *RESULT})
    # The input's columns get numbers for names here, so that none clashes.
    own = ["_c0", *(f"_c{i + 1}" for i in range(len(carry)))]
    names = [F.col(c).alias(n) for c, n in zip((key, *carry), own, strict=True)]
    sized = written(docs.select(*names, F.col(source).alias("_source"), words_in(F.col(text)).alias("size")), "sized")
    counts = written(sized.groupBy("_source", "size").agg(F.count("*").alias("n")), "sizes")
    sources = written(targets(counts, "_source"), "sources")
    same = lambda a: a["_source"].eqNullSafe(sources["_source"])
    sizes = written(counts.join(sources, same(counts)).select("sid", "size", "n"), "sizes")
    solved = written(sources.join(multipliers(sizes, sources), "sid", "left"), "solved")

    equal = sized.groupBy("_source", *own, "size").agg(F.count("*").alias("n"))
    known = equal.join(solved, equal["_source"].eqNullSafe(solved["_source"]))
    full = F.when(F.col("target") > 0, float(MOST)).otherwise(0.0)
    known = known.withColumn("rate", F.when(F.col("lam").isNull(), full).otherwise(rate(F.col("size"), F.col("lam"))))
    name = F.md5(F.concat_ws(":", *(F.col(c).cast("string") for c in own), F.col("size").cast("string")))
    block = F.pmod(F.conv(F.substring(name, 1, 8), 16, 10).cast("bigint"), F.ceil(F.col("n_docs") / BLOCK_ROWS))
    blocks = known.groupBy("sid", block.alias("_block")).agg(F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sort_array(F.collect_list(F.struct("size", *own, "rate", "n")), asc=False).alias("_rows"))
    blocks = blocks.withColumn("_copies", _copies(F.col("_rows")))
    taken = F.transform("_rows", lambda x, i: F.struct(x.alias("r"), F.get(F.col("_copies"), i).alias("copies")))
    rows = blocks.select("source_size", "target", F.explode(taken).alias("_x")).select("source_size", "target", "_x.r.*", "_x.copies")
    # Row number p of n takes one more than the even share if it is among the first of them.
    rows = rows.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(APART).cast("bigint"))))
    rows = rows.withColumn("_p", F.explode(F.sequence(F.col("_at"), F.least(F.col("n"), F.col("_at") + APART) - 1)))
    each = F.floor(F.col("copies") / F.col("n")) + (F.col("_p") < F.col("copies") % F.col("n")).cast("int")
    return rows.select(*(F.col(n).alias(c) for c, n in zip((key, *carry), own, strict=True)), "size", "source_size", "target", "rate", each.cast("int").alias("copies"))


def repeated(docs: DataFrame, mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows of one key share its copies evenly, rounded.

    Both sides have a row per document, so they are always merged by key, and never broadcast.
    """
    per = mixed.groupBy(F.col(key).alias(KEY)).agg(F.round(F.sum("copies") / F.count("*")).cast("int").alias(COPIES))
    joined = docs.join(per.filter(F.col(COPIES) > 0).hint("merge"), docs[key].eqNullSafe(F.col(KEY)))
    return joined.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), F.col(COPIES)))).select(*docs.columns)
