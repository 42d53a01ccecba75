from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidemill.llm import packing, queries

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def exact():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.byte_bpe())
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, queries.END_ID]


def check(rows, texts, exact):
    """The pieces are the texts' ids, and sequences are gapless; how many there are, and at least must be."""
    ids = {k: exact(t) for k, t in texts.items()}
    seen, places = defaultdict(list), defaultdict(list)
    for r in rows:
        own = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], dtype="<u4")
        assert zlib.crc32(own.tobytes()) == r["ids_crc32"]
        assert 0 < r["length"] == len(own) <= queries.SEQUENCE_TOKENS
        seen[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, pieces in seen.items():
        pieces.sort()
        assert [p for p, _, _ in pieces] == list(range(len(pieces)))
        assert [s for _, s, _ in pieces] == [sum(n for _, _, n in pieces[:i]) for i in range(len(pieces))]
        assert all(n == queries.SEQUENCE_TOKENS for _, _, n in pieces[1:])
        assert sum(n for _, _, n in pieces) == len(ids[k])
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
    return len(places), -(-sum(len(x) for x in ids.values()) // queries.SEQUENCE_TOKENS)


def test_query_packs_every_token(spark, exact):
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SF, "documents").collect()}
    rows = queries.op1_pack(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    used, least = check(rows, texts, exact)
    assert used <= 1.03 * least + 1


def test_many_small_partitions_waste_little(spark):
    rng = random.Random(1)
    sizes = [(i, rng.randint(1, 300)) for i in range(4000)]
    df = spark.createDataFrame(sizes, "i int, n int").repartition(40)
    rows = packing.pack(df, "n", 1024, open_bins=64).collect()
    assert len(rows) == 4000
    assert len({r["sequence_id"] for r in rows}) <= 1.03 * sum(n for _, n in sizes) / 1024 + 3


def plain_best_fit(lengths, capacity, limit):
    """(bin, offset) of each length as it arrives, and which bins stay open, by lists."""
    bins, out, made, most = [], [], 0, 0
    for n in lengths:
        fits = [b for b in bins if b[0] >= n]
        if fits:
            free = min(b[0] for b in fits)
            b = [b for b in fits if b[0] == free][-1]
            bins.remove(b)
        else:
            if len(bins) == limit and n < capacity:
                free = min(b[0] for b in bins)
                bins.remove([b for b in bins if b[0] == free][-1])
            b, made = [capacity, made], made + 1
        out.append((b[1], capacity - b[0]))
        b[0] -= n
        if b[0]:
            bins.append(b)
        most = max(most, len(bins))
    return out, {b[1] for b in bins}, most


@pytest.mark.parametrize("flush", [7, 4096])
def test_rows_are_placed_as_they_arrive_in_so_many_bins_at_most(spark, monkeypatch, flush):
    rng = random.Random(8)
    lengths = [rng.choice((rng.randint(1, 100), 100, rng.randint(1, 12))) for _ in range(1500)]
    expected, open_, most = plain_best_fit(lengths, 100, 9)
    assert most == 9
    bins = packing.Bins(100, 9)
    for n, at in zip(lengths, expected, strict=True):
        assert bins.place(n) == at
        assert bins.n <= 9
    assert set(bins.open()) == open_
    df = spark.createDataFrame(list(enumerate(lengths)), "i int, n int").coalesce(1).sortWithinPartitions("i")
    rows = {r["i"]: (r["sequence_id"], r["offset"]) for r in packing.pack(df, "n", 100, open_bins=9).collect()}
    base = min(s for s, _ in rows.values())
    first = {i: (s - base, o) for i, (s, o) in rows.items() if s < 1 << 62}
    assert first == {i: p for i, p in enumerate(expected) if p[0] not in open_}
    again = [i for i, (s, _) in rows.items() if s >= 1 << 62]
    assert {expected[i][0] for i in again} == open_


def test_groups_of_the_second_pass_are_bounded_and_placed_as_they_arrive(spark):
    """Lengths of a group are in no order, its bins close, and it holds so many bins' worth."""
    rng = random.Random(3)
    sizes = [(i, rng.randint(1, 90)) for i in range(6000)]
    rows = packing.pack(spark.createDataFrame(sizes, "i int, n int").repartition(60), "n", 100, open_bins=4).collect()
    groups = defaultdict(list)
    for r in rows:
        if r["sequence_id"] >= 1 << 62:
            groups[(r["sequence_id"] >> 32)].append((r["sequence_id"], r["offset"], r["n"]))
    assert len(groups) > 1
    for own in groups.values():
        assert sum(n for *_, n in own) <= 2 * packing.GROUP_BINS * 4 * 100
        firsts = [n for _, o, n in sorted(own) if o == 0]
        assert firsts != sorted(firsts, reverse=True)


def test_most_rows_are_placed_once_and_bins_close_unfull(spark):
    """At a tenth: the rows that come through the second pass, the bins closed unfull, and how many sequences there are."""
    rows = queries.op1_pack(spark, f"{DATA}/sf0.1").select("sequence_id", "length").toPandas()
    again = rows["sequence_id"] >= 1 << 62
    assert again.mean() < 0.05
    filled = rows[~again].groupby("sequence_id")["length"].sum()
    assert (filled < queries.SEQUENCE_TOKENS).sum() > 1000
    assert rows["sequence_id"].nunique() <= 1.0115 * rows["length"].sum() / queries.SEQUENCE_TOKENS


def test_bins_prefer_the_tightest_and_close_the_fullest():
    bins = packing.Bins(10, 2)
    assert [bins.place(n)[0] for n in (6, 5, 4, 5)] == [0, 1, 0, 1]
    assert bins.open() == []
    a, b = bins.place(7)[0], bins.place(8)[0]
    c = bins.place(9)[0]
    assert sorted(bins.open()) == sorted([a, c])
    assert b not in bins.open()


def test_odd_rows(odd, exact):
    out = queries.packed_digest(odd).collect()
    assert sum(r["length"] for r in out if r["doc_id"] in (7, 8)) == 2
    assert sorted((r["doc_id"] or 0) for r in out if r["piece"] == 0) == sorted((r["doc_id"] or 0) for r in odd.select("doc_id").collect())


def test_clashing_columns_are_replaced_and_others_kept(odd):
    out = packing.pack(odd.withColumn("len", F.lit(3)), "len", 10)
    assert out.columns[-2:] == ["sequence_id", "offset"]
    assert set(odd.columns) <= set(out.columns)
    assert out.count() == odd.count()
    assert out.schema["sequence_id"].dataType.typeName() == "long"


def test_empty_table(none):
    assert queries.packed_digest(none).count() == 0


def test_sequences_hold_the_tokens(spark, exact):
    docs = spark.createDataFrame([(1, "some words here"), (2, "others")], "doc_id long, text string")
    packed = packing.pack(packing.pieces(docs, queries.byte_bpe(), 1024, 2), "length", 1024)
    row = packing.sequences(packed).collect()
    assert len(row) == 1
    found = np.frombuffer(bytes(row[0]["ids"]), dtype="<u4").tolist()
    assert found in (exact("some words here") + exact("others"), exact("others") + exact("some words here"))


def test_encoder_equals_tokenizers(exact):
    encode = packing.Encoder(queries.byte_bpe())
    texts = ["", " ", "a  b\n\n\tc", "<|endoftext|> don't", "é中文😀 1234", "x" * 5000, " " * 3_000_000 + "x", *(chr(c) + " " + chr(c) * 3 for c in range(1, 0x3000, 7))]
    for t in texts:
        assert encode(t).tolist() == exact(t)[:-1]


def test_pieces_are_full_but_the_first():
    assert packing.piece_bounds(5, 10) == [0, 5]
    assert packing.piece_bounds(10, 10) == [0, 10]
    assert packing.piece_bounds(25, 10) == [0, 5, 15, 25]
