"""Many phrases at once: one automaton over all literals of a rule table, one pass over each text.

Texts are folded by Spark; a task builds the automaton once (a worker keeps it) and gives, per text,
which phrases occur and where first.  Patterns are tried by Spark, and only on texts that hold their
phrase.  So the time follows the texts and what is found in them, not the number of rules.

The rule table goes to the tasks in lots of at most ``MOST_CHARS`` of phrases; a larger table takes one
pass over the texts a lot.  Rows with a null or empty phrase find nothing; a null text holds nothing.
Rules of one name are one rule that finds what any of them does, at the first place; rows of one key are one
document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.rules import folded

#: An automaton takes some hundred bytes a character.
MOST_CHARS = 1_000_000

#: The last automaton of a worker process, by the digest of its phrases.
_built: dict[str, object] = {}


def automaton(literals: list[str]):
    """An automaton that gives the numbers of the literals that it meets."""
    mark = hashlib.sha256("\0".join(literals).encode()).hexdigest()
    if mark not in _built:
        import ahocorasick

        made = ahocorasick.Automaton()
        for i, literal in enumerate(literals):
            made.add_word(literal, i)
        made.make_automaton()
        _built.clear()
        _built[mark] = made
    return _built[mark]


def occurrences(texts: DataFrame, literals: list[str], folded_text: str) -> DataFrame:
    """``texts`` with ``_hits``, an array of (number, at, n) for the distinct literals that each folded text holds.

    ``at`` is the first place in code points, ``n`` how often, also overlapping.
    """
    hit = T.ArrayType(T.StructType([T.StructField("number", T.IntegerType()), T.StructField("at", T.LongType()), T.StructField("n", T.LongType())]))
    schema = T.StructType([*(f for f in texts.schema if f.name != folded_text), T.StructField("_hits", hit)])
    kept = [n for n in schema.names if n != "_hits"]
    kind = pa.list_(pa.struct([("number", pa.int32()), ("at", pa.int64()), ("n", pa.int64())]))
    lengths = [len(x) for x in literals]

    def found(text: str, made) -> list[dict]:
        seen: dict[int, list[int]] = {}
        for end, number in made.iter(text):
            if number in seen:
                seen[number][1] += 1
            else:
                seen[number] = [end + 1 - lengths[number], 1]
        return [{"number": k, "at": at, "n": n} for k, (at, n) in seen.items()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = automaton(literals)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(folded_text))
            hits = [found(column[i].as_py() or "", made) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in kept), pa.array(hits, kind)], names=schema.names)

    return texts.mapInArrow(scan, schema)


def phrase_hits(docs: DataFrame, used: DataFrame, key: str, text: str = "text", most_chars: int = MOST_CHARS) -> DataFrame:
    """(key, name, first_at, n) for each document and rule of ``used`` (name, phrase, pattern) that finds something in it.

    A rule finds something where the folded text holds its folded phrase and, if it has a pattern, the text
    matches that.  ``first_at`` and ``n`` are the phrase's first place and number of places.
    """
    spark = docs.sparkSession
    known = used.select("name", folded(F.col("phrase")).alias("phrase"), "pattern").filter("phrase <> ''").distinct()
    chars = known.agg(F.sum(F.length("phrase"))).first()[0] or 0
    lots = -(-chars // most_chars)
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("name", used.schema["name"].dataType), T.StructField("first_at", T.LongType()), T.StructField("n", T.LongType())])
    out = spark.createDataFrame([], schema)
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"), folded(F.col(f"`{text}`")).alias("_low")).filter("_low <> ''")
    for lot in range(lots):
        # A lot is a share of the table by hash: about ``most_chars``, or one longer phrase.
        part = known.filter(F.pmod(F.xxhash64("phrase"), F.lit(lots)) == lot).toArrow().to_pylist()
        literals = sorted({r["phrase"] for r in part})
        number = {x: i for i, x in enumerate(literals)}
        ruled = spark.createDataFrame([(number[r["phrase"]], r["name"], r["pattern"]) for r in part], T.StructType([T.StructField("_number", T.IntegerType()), T.StructField("name", used.schema["name"].dataType), T.StructField("pattern", T.StringType())]))
        hits = occurrences(rows, literals, "_low").filter(F.size("_hits") > 0)
        each = hits.select("_key", "_text", F.explode("_hits").alias("_hit")).join(F.broadcast(ruled), F.col("_hit.number") == F.col("_number"))
        each = each.filter(F.col("pattern").isNull() | F.expr("_text rlike pattern"))
        out = out.unionByName(each.select(F.col("_key").alias(key), "name", F.col("_hit.at").alias("first_at"), F.col("_hit.n").alias("n")))
    return out.groupBy(key, "name").agg(F.min("first_at").alias("first_at"), F.sum("n").alias("n"))
