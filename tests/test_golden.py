"""How often the rules are right on texts that they were not written on: precision and recall of each kind, by clauses."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests import golden_texts as golden
from tidemill.functions import rules
from tidemill.operators import scanning

#: (precision, recall) that each kind has at least; the README states what was measured.
FLOORS = {"barrier": (0.95, 0.9), "agent": (0.95, 0.9), "pay": (0.95, 0.9)}


@pytest.fixture(scope="module")
def found(spark):
    """What is found in each text, by text."""
    texts = [*golden.BARRED, *golden.OPEN, *golden.DIRECTED, *golden.HUMAN, *(t for t, *_ in golden.PAID), *golden.UNPAID]
    rows = scanning.findings(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    return {r["text"]: r for r in rows}


def rates(right, wrong):
    """Precision and recall, from whether each text of the two lots is found, and what is mistaken."""
    hits = sum(right.values())
    missed, alarms = [t for t, x in right.items() if not x], [t for t, x in wrong.items() if x]
    return hits / max(1, hits + len(alarms)), hits / len(right), (missed, alarms)


def measure(found):
    flag = lambda texts, c: {t: found[t][c] for t in texts}
    as_said = lambda x, p: p is not None and (float(p["min"]), float(p["max"]), p["currency"], p["period"]) == tuple(x)
    return {
        "barrier": rates(flag(golden.BARRED, "sponsorship_barrier"), flag(golden.OPEN, "sponsorship_barrier")),
        "agent": rates(flag(golden.DIRECTED, "agent_directed"), flag(golden.HUMAN, "agent_directed")),
        "pay": rates({t: as_said(x, found[t]["pay"]) for t, *x in golden.PAID}, {t: found[t]["pay"] is not None for t in golden.UNPAID}),
    }


@pytest.mark.parametrize("kind", FLOORS)
def test_precision_and_recall(found, kind):
    precision, recall, mistakes = measure(found)[kind]
    assert len(golden.BARRED) == len(golden.OPEN) == len(golden.DIRECTED) == len(golden.HUMAN) == len(golden.PAID) == len(golden.UNPAID) == 50
    assert precision >= FLOORS[kind][0], mistakes
    assert recall >= FLOORS[kind][1], mistakes


def test_what_is_found_is_where_it_is_said(found):
    for text, row in found.items():
        assert {s["rule"] for s in row["spans"]} == set(row["evidence"]), text
        for s in row["spans"]:
            assert 0 <= s["start"] < s["end"] <= len(text)
            rule = next(r for r in rules.RULES if r.name == s["rule"])
            said = text[s["start"] : s["end"]].lower()
            assert said[0].isalnum() or said[0] == "'", (text, said)
            if rule.kind == "barrier":
                assert any(n in said for n in rule.needs), (text, said)


def test_places_count_characters_and_turns(spark):
    text = "😀 Éa. We sponsor some, but we do not sponsor interns. U.S. citizenship is required!\nNo visa sponsorship"
    row = scanning.findings(spark.createDataFrame([(text,)], "text string")).first()
    assert [(s["rule"], text[s["start"] : s["end"]]) for s in row["spans"]] == [("no_sponsorship", "No visa sponsorship"), ("will_not_sponsor", "not sponsor"), ("citizens_only", "U.S. citizenship is required")]


def test_a_very_long_clause_and_a_very_long_text(spark):
    clause = "word " * 40_000 + "no visa sponsorship"
    many = "We sponsor. Nothing else! " * 5_000 + "Must be a US citizen."
    rows = spark.createDataFrame([(clause,), (many,)], "text string")
    got = [r["evidence"] for r in scanning.findings(rows).collect()]
    assert got == [["no_sponsorship"], ["citizens_only"]]


def test_every_pattern_is_one(spark):
    patterns = [p for r in rules.RULES + rules.STAND_IN for p in (r.pattern, r.unless)]
    assert len(spark.createDataFrame([("x",)], "x string").select(*(F.col("x").rlike(p).alias(f"p{i}") for i, p in enumerate(patterns))).first()) == len(patterns)
