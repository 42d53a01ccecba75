"""Counts of tokens: batch encoding in Arrow functions that return lengths only.

A task streams its texts in slices of about ``SLICE_BYTES``.  Every text is split where no token
can reach across (``safe``); the pieces of a slice become one dictionary, so that each distinct one
is encoded once, in batches of about ``BATCH_BYTES``, and only its length is kept.  A text's count
is the sum over its pieces.  Lengths are remembered by worker in two generations of ``KEPT_BYTES`` of pieces;
what is not met again goes, which costs time but changes nothing.  A very long text is one slice: its
pieces are offsets into the batch that Arrow holds anyway, and no tokens are kept.

Where pieces may begin is known for two kinds of files, told by their contents: those that drop
white space and split words, digits and signs, and byte-level ones.  Texts for any other file are
encoded whole, in the same batches.

Nulls: a null text counts as empty and has no tokens; ids may be null, repeated or of any type, for
every row stands for itself.  An empty table gives no rows.  Only the key is carried.
"""

from __future__ import annotations

import json
import os
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemill.llm import bytetext

SLICE_BYTES = 1 << 21
BATCH_BYTES = 1 << 16
#: Characters of pieces whose lengths a worker remembers, and how long a piece may be for that.
KEPT_BYTES = 1 << 22
KEPT_PIECE = 256

def _bytes(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in chars]] = True
    return out


_LETTER = _bytes(string.ascii_letters)
_DIGIT = _bytes(string.digits)
#: A bar may belong to a special string, and an apostrophe goes with the letters of a contraction behind it.
_SIGN = _bytes(string.punctuation.replace("|", ""))
_OPENER = _bytes(string.punctuation.replace("|", "").replace("'", ""))

#: What every special string of such a file begins with.
SPECIAL_MARK = b"<|"

#: How a file says that it splits words, digits and signs and drops white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def after_words(data: np.ndarray) -> np.ndarray:
    """Where a piece may begin if white space is dropped and each digit is a token.

    At and after a run of ASCII white space, at and after an ASCII digit, and between an ASCII letter
    and a sign: no word, contraction, run of signs, composed character or special string holds such
    a place.
    """
    begins = np.zeros(len(data), dtype=bool)
    space, digit, letter = bytetext.SPACE[data], _DIGIT[data], _LETTER[data]
    begins[1:] = (space[1:] != space[:-1]) | digit[1:] | (digit[:-1] & (data[1:] < 128)) | (letter[:-1] & _SIGN[data][1:]) | (_OPENER[data][:-1] & letter[1:])
    return begins


def between_letters(data: np.ndarray) -> np.ndarray:
    """Where a piece may begin if a space goes with the word behind it: at single spaces between ASCII letters."""
    begins = np.zeros(len(data), dtype=bool)
    letter = _LETTER[data]
    begins[1:-1] = (data == 32)[1:-1] & letter[:-2] & letter[2:]
    return begins


def safe(made: dict) -> Callable[[np.ndarray], np.ndarray] | None:
    """Where texts may be split for the file with these contents; None if that isn't known."""
    plain = [t["content"] for t in made["added_tokens"]]
    if made.get("truncation") or made.get("padding") or any(t["single_word"] or t["normalized"] for t in made["added_tokens"]):
        return None
    normal, split = made["normalizer"] or {}, made["pre_tokenizer"] or {}
    kinds = [n["type"] for n in normal.get("normalizers", [])]
    parts = split.get("pretokenizers", [])
    if (
        kinds == ["NFC", "Replace", "Lowercase"]
        and normal["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
        and [p["type"] for p in parts] == ["Split", "ByteLevel"]
        and parts[0]["pattern"] == {"Regex": WORD_PATTERN}
        and (parts[0]["behavior"], parts[0]["invert"]) == ("Removed", True)
        and not (parts[1]["add_prefix_space"] or parts[1]["use_regex"])
    ):
        rule = after_words
    elif not normal and split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]:
        rule = between_letters
    else:
        return None
    whole = [np.frombuffer(p.encode(), np.uint8) for p in plain]
    return None if any(rule(w).any() or not p.startswith(SPECIAL_MARK.decode()) for p, w in zip(plain, whole, strict=True)) else rule


def encoder(path: str) -> tuple[Callable[[list[str]], list[int]], Callable | None]:
    """How many tokens each of some texts has for the file at ``path``, and where texts may be split."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], None
    # Tasks run side by side already.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    with open(path, encoding="utf-8") as f:
        rule = safe(json.load(f))
    return lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)], rule


class Lengths:
    """Lengths of pieces, encoded in batches that are even in bytes and remembered within bounds."""

    def __init__(self, tokenizer: str, batch_bytes: int = BATCH_BYTES, kept_bytes: int = KEPT_BYTES):
        self.encode, self.rule = encoder(tokenizer)
        self.batch_bytes, self.kept_bytes = batch_bytes, kept_bytes
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.held = 0

    def of(self, pieces: list[str]) -> np.ndarray:
        found = list(map(self.known.get, pieces))
        batch: list[int] = []
        size = 0
        for i in (i for i, n in enumerate(found) if n is None):
            n = self.older.get(pieces[i])
            if n is not None:
                found[i] = n
                self._keep(pieces[i], n)
                continue
            if batch and size + len(pieces[i]) > self.batch_bytes:
                self._encoded(pieces, batch, found)
                batch, size = [], 0
            batch.append(i)
            size += len(pieces[i])
        if batch:
            self._encoded(pieces, batch, found)
        return np.array(found, dtype=np.int64)

    def _encoded(self, pieces: list[str], batch: list[int], found: list[int | None]) -> None:
        for i, n in zip(batch, self.encode([pieces[i] for i in batch]), strict=True):
            found[i] = n
            self._keep(pieces[i], n)

    def _keep(self, piece: str, n: int) -> None:
        if len(piece) > KEPT_PIECE:
            return
        if self.held > self.kept_bytes:
            self.known, self.older, self.held = {}, self.known, 0
        self.known[piece] = n
        self.held += len(piece)


#: A worker process keeps what it has learnt of a file from one task to the next.
_lengths: dict[str, Lengths] = {}


def counted(data: np.ndarray, offsets: np.ndarray, lengths: Lengths) -> np.ndarray:
    """The tokens of each text, given as bytes and the offsets of the texts in them."""
    if not len(data):
        return np.zeros(len(offsets) - 1, dtype=np.int64)
    begins = lengths.rule(data) if lengths.rule is not None else np.zeros(len(data), dtype=bool)
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    if lengths.rule is after_words:
        # White space has no tokens, and letters count in lower case; special strings are told apart by case.
        kept = ~bytetext.SPACE[data]
        places = np.concatenate([[0], np.cumsum(kept)])
        data, begins, offsets = data[kept], begins[kept], places[offsets]
        if SPECIAL_MARK not in data.tobytes():
            data = bytetext.LOWER[data]
    starts = np.flatnonzero(begins)
    pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    coded = pieces.dictionary_encode()
    sums = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(lengths.of(coded.dictionary.to_pylist())[coded.indices.to_numpy()], out=sums[1:])
    return np.diff(sums[np.searchsorted(starts, offsets)])


def count_tokens(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (key, n_bytes, n_tokens) per row: the text's UTF-8 bytes and how many tokens it has.

    ``tokenizer`` is a file of the tokenizers library (.json) or of sentencepiece (.model), readable at
    this path by every task.  No tokens are added at the ends, special strings are as the file says.
    """
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _lengths:
            _lengths[tokenizer] = Lengths(tokenizer)
        for rows, data, offsets in bytetext.slices(batches, "_text", SLICE_BYTES):
            n = counted(data, offsets, _lengths[tokenizer])
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(offsets)), pa.array(n)], names=schema.names)

    return df.selectExpr(f"`{key}` AS _key", f"`{text}` AS _text").mapInArrow(count, schema)
