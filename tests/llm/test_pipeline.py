from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tests.conftest import DATA
from tests.llm.test_line_dedup import brute as dedup_by_brute_force
from tests.llm.test_near_dedup import brute as groups_by_brute_force
from tests.llm.test_packing import exact  # noqa: F401
from tidemill.llm import mixing, queries

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after every stage, and before the first."""
    out = tmp_path_factory.mktemp("stages")
    docs = queries.table(spark, SF, "documents")
    found = [docs.collect()]
    for i, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, SF).write.parquet(str(out / str(i)))
        docs = spark.read.parquet(str(out / str(i)))
        found.append(docs.collect())
    return found


def texts(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


def test_stages_return_the_columns_of_documents(spark, stages):
    columns = queries.table(spark, SF, "documents").columns
    assert all(rows[0].__fields__ == columns for rows in stages[:-1])
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_quality_drops_what_it_rejects(spark, stages):
    scores = {r["doc_id"]: r["predicted"] for r in queries.op5_quality(spark, SF).collect()}
    assert texts(stages[1]) == texts([r for r in stages[0] if scores[r["doc_id"]]])
    assert 0 < len(stages[1]) < len(stages[0])


def test_lines_as_by_brute_force(stages):
    expected = dedup_by_brute_force([(r["doc_id"], r["text"]) for r in stages[1]])
    assert texts(stages[2]) == Counter({(d, t): n for (d, _, _, t), n in expected.items()})
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2])


def test_one_of_each_group_as_by_brute_force(stages):
    components, _ = groups_by_brute_force([(r["doc_id"], r["text"]) for r in stages[2]], 5)
    assert texts(stages[3]) == texts([r for r in stages[2] if components[r["doc_id"]] == r["doc_id"]])


def test_mix_takes_the_copies(spark, stages):
    schema = queries.table(spark, SF, "documents").schema
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(stages[3], schema)).collect()}
    assert texts(stages[4]) == Counter({(r["doc_id"], r["text"]): copies[r["doc_id"]] for r in stages[3] if copies[r["doc_id"]]})


def test_packed(stages, exact):  # noqa: F811
    copies, seen = Counter(r["doc_id"] for r in stages[4]), Counter(r["doc_id"] for r in stages[5] if r["piece"] == 0)
    assert copies == seen
    texts_of = {r["doc_id"]: r["text"] for r in stages[4]}
    for r in stages[5]:
        own = np.array(exact(texts_of[r["doc_id"]])[r["start"] : r["start"] + r["length"]], dtype="<u4")
        assert 0 < r["length"] == len(own) <= queries.SEQUENCE_TOKENS
        assert zlib.crc32(own.tobytes()) == r["ids_crc32"]
    places = {}
    for r in stages[5]:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
    assert len(places) <= 1.05 * sum(r["length"] for r in stages[5]) / queries.SEQUENCE_TOKENS + 1


def test_run_equals_its_stages(spark, stages):
    digest = lambda rows: Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows)
    assert digest(corpus_pipeline.run(spark, SF).collect()) == digest(stages[-1])


def test_empty_and_odd_documents(spark, odd, none, exact):  # noqa: F811
    for given in (none, odd):
        docs = given.withColumn("n_chars", given.doc_id * 0)
        columns, before = docs.columns, docs.collect()
        for name, f in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(f(spark, docs, SF).collect(), f(spark, docs, SF).schema)
            assert docs.columns == columns
            rows = docs.collect()
            # Ids and further columns come through as they were.
            assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in before}
            assert {r[c] for r in rows for c in columns if c not in ("doc_id", "text", "source", "n_chars")} <= {"-"}
            if name == "line dedup":
                expected = dedup_by_brute_force([(r["doc_id"], r["text"]) for r in before])
                assert Counter((r["doc_id"], r["text"] or "") for r in rows) == Counter({(d, t or ""): n for (d, _, _, t), n in expected.items()})
            if name == "near-dedup":
                components, _ = groups_by_brute_force([(r["doc_id"], r["text"]) for r in before], 5)
                assert texts(rows) == texts([r for r in before if components[r["doc_id"]] == r["doc_id"]])
            if name == "mixing":
                assert set(texts(rows)) <= set(texts(before))
                assert max(texts(rows).values(), default=0) <= 3 * max(texts(before).values(), default=1)
            before = rows
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        whole = Counter((r["doc_id"], len(exact(r["text"]))) for r in before)
        first = Counter((r["doc_id"], r["length"]) for r in packed if r["piece"] == 0)
        assert sum(first.values()) == sum(whole.values())
        assert sum(r["length"] for r in packed) == sum(n * k for (_, n), k in whole.items())
        assert Counter(d for d, _ in first.elements()) == Counter(d for d, _ in whole.elements())
        assert (len(packed) == 0) == (given is none)
