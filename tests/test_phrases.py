"""Many phrases in one pass find what each rule by itself finds."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from tests.conftest import DATA
from tidemill.functions import rules
from tidemill.operators import phrases
from tidemill.plans import catalog

RULES = "name string, phrase string, pattern string"


def plain(docs, used):
    """By Spark's own search, a rule at a time."""
    low = rules.folded(F.col("text"))
    pairs = docs.join(used, F.contains(low, rules.folded(F.col("phrase"))) & (F.col("phrase") != "")).filter("pattern is null or text rlike pattern")
    return {(r["id"], r["name"]): r["at"] for r in pairs.select("id", "name", (F.expr("locate(lower(phrase), lower(text))") - 1).alias("at")).groupBy("id", "name").agg(F.min("at").alias("at")).collect()}


def test_a_thousand_rules_find_what_each_finds(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    used = [(f"r{i}", " ".join(rng.choice(words) for _ in range(rng.randint(1, 2))).upper() if i % 3 else rng.choice(words), rng.choice([None, None, "(?i)b.*a", "^[a-c]"])) for i in range(1000)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(60)).title()) for i in range(80)] + [(90, None), (91, "")], "id int, text string").repartition(3)
    table = spark.createDataFrame([*used, ("none", None, None), ("empty", "", None)], RULES)
    expected = plain(docs, table)
    assert len(expected) > 5000
    for most in (phrases.MOST_CHARS, 700):
        got = phrases.phrase_hits(docs, table, "id", most_chars=most).collect()
        assert {(r["id"], r["name"]): r["first_at"] for r in got} == expected


def test_places_are_counted_in_characters(spark):
    docs = spark.createDataFrame([("a", "😀É aaaa"), ("a", None)], "k string, body string")
    used = spark.createDataFrame([("aa", "AA", None), ("é", "É", None), ("two", "é", None), ("two", "a", "a+$"), ("no", "a", "^a")], RULES)
    got = {r["name"]: (r["first_at"], r["n"]) for r in phrases.phrase_hits(docs, used, "k", "body").collect()}
    assert got == {"aa": (3, 3), "é": (1, 1), "two": (1, 5)}
    assert phrases.phrase_hits(docs, used.limit(0), "k", "body").count() == 0


def test_letters_that_patterns_fold_are_found(spark):
    docs = spark.createDataFrame([(1, "a TOKEN and ſecret")], "k int, text string")
    used = spark.createDataFrame([("t", "token", None), ("s", "Secret", "(?iu)secret")], RULES)
    assert {r["name"] for r in phrases.phrase_hits(docs, used, "k").collect()} == {"t", "s"}


def test_time_does_not_follow_the_number_of_rules(spark):
    docs = catalog.table(spark, f"{DATA}/sf0.01", "documents").select("doc_id", "text").repartition(2).cache()
    docs.count()

    def took(n):
        used = spark.createDataFrame([(f"r{i}", f"q{i} zz", None) for i in range(n)], RULES)
        phrases.phrase_hits(docs, used, "doc_id").count()
        begun = time.time()
        phrases.phrase_hits(docs, used, "doc_id").count()
        return time.time() - begun

    few, many = took(10), took(5000)
    assert many < 3 * few + 2
