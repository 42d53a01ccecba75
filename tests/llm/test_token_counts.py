from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

from tests.conftest import DATA
from tidemill.llm import queries, token_counts

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"]


def library(name):
    """How many tokens a text has, by the library itself on the whole text."""
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


def counts(texts, lengths):
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    return token_counts.counted(np.frombuffer(b"".join(data), np.uint8), offsets, lengths).tolist()


def odd_texts(n, seed):
    """Texts out of what could join across a split: marks, signs, contractions, special strings, odd spaces."""
    rng = random.Random(seed)
    parts = [
        *"aezAEZ019 \t\n\r\x0b\x0c.,;:!?()'\"<>|=-_&*", "́", "̸", "‍", "\x1c", "\x85", "\xa0", "　", "é", "É", "ß", "İ", "Σ", "ς", "ﬁ", "中", "文", "😀", "²", "½", "'s", "'S", "'re", "'ll", "’s",
        "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "word", "Words", "http://a.b/c?d=1", "1,234.50", "\x00", "é", "≮", "1⃣", "가", "각", "ᄀ", "ᅡ",
    ]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("name", FILES)
def test_pieces_add_up_to_the_whole(name):
    lengths, whole = token_counts.Lengths(public_tokenizers.path(name)), library(name)
    texts = odd_texts(3000, 5)
    assert counts(texts, lengths) == [whole(t) for t in texts]


def test_both_kinds_of_files_are_known_and_split():
    rules = [token_counts.encoder(public_tokenizers.path(n))[1] for n in FILES]
    assert rules == [token_counts.after_words, token_counts.between_letters, None]
    assert token_counts.safe({"normalizer": None, "pre_tokenizer": None, "added_tokens": []}) is None


def test_what_is_remembered_is_bounded_and_changes_nothing():
    path, whole = public_tokenizers.path(FILES[0]), library(FILES[0])
    lengths = token_counts.Lengths(path, batch_bytes=50, kept_bytes=200)
    texts = odd_texts(300, 6) * 2
    for t in texts:
        assert counts([t], lengths) == [whole(t)]
        assert sum(map(len, lengths.known)) <= 200 + token_counts.KEPT_PIECE
        assert sum(map(len, lengths.older)) <= 200 + token_counts.KEPT_PIECE


def test_batches_are_even_in_bytes(monkeypatch):
    lengths = token_counts.Lengths(public_tokenizers.path(FILES[0]), batch_bytes=1000)
    seen, encode = [], lengths.encode
    lengths.encode = lambda texts: (seen.append(sum(map(len, texts))), encode(texts))[1]
    lengths.of([f"w{i}" * (i % 7 + 1) for i in range(3000)])
    assert len(seen) > 10
    assert max(seen) <= 1000
    assert min(seen[:-1]) > 900


def test_query_equals_the_library(spark):
    sf, whole = f"{DATA}/sf0.001", library(FILES[0])
    docs = queries.table(spark, sf, "documents").collect()
    expected = sorted((r["doc_id"], len(r["text"].encode()), n := whole(r["text"]), n > 2048) for r in docs)
    out = queries.op11_tokens(spark, sf)
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert sorted(map(tuple, out.collect())) == expected


def test_odd_rows_and_long_texts(odd, none, spark):
    path, whole = public_tokenizers.path(FILES[0]), library(FILES[0])
    rows = odd.select("doc_id", "text").collect()
    found = token_counts.count_tokens(odd, path)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens"]
    by = lambda x: [(k is None, k or 0, *r) for k, *r in x]
    assert sorted(by(map(tuple, found.collect()))) == sorted(by((r["doc_id"], len((r["text"] or "").encode()), whole(r["text"] or "")) for r in rows))
    assert token_counts.count_tokens(none, path).count() == 0
    long = ["word " * 1_200_000, "x" * 300_000, "é" * 100_000 + "\n" + "1" * 3_000_000]
    df = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(long)], "`a key` string, `the text` string").coalesce(1)
    out = {r[0]: r["n_tokens"] for r in token_counts.count_tokens(df, path, "a key", "the text").collect()}
    assert out == {"k0": 1_200_000, "k1": whole(long[1]), "k2": whole("é" * 100_000) + 3_000_000}
