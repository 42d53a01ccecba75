"""Secret scans with linking of credentials that come in parts.

Base spans are matches that tell a secret by themselves: an assignment to a secret's name
(``assign``), a cloud access identifier (``access``) and a long run of hexadecimal digits (``hex``).

Weak candidates tell little alone: names of accounts (``link_id``), short or bare passwords
(``link_secret``) and addresses of services (``link_endpoint``).  Each has a scope: ``REACH`` code points
to either side, up to the nearest empty line.  Candidates and base spans are interval-joined with
the scopes; a candidate is reported only if complementary parts lie in its scope: an identifier needs
a secret, a secret an identifier or an endpoint, an endpoint both.  The join is a semi-join over
sorted ends, two searches for each candidate and kind, so no pairs are made.

Spans are in code points, their ends exclusive.  They come by start, then kind in the order of
``KINDS``.  A null or empty text has no spans.  Each row is scanned by itself, so repeated rows and ids
come as they are; an empty table gives no rows.  Every pattern takes time in proportion to the text,
however long a text, a key or an address is.  A column named like the added one is replaced, other
columns stay, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BASE = ("assign", "access", "hex")
LINKED = ("link_id", "link_secret", "link_endpoint")
KINDS = BASE + LINKED
REACH = 200
ROWS = 512

# Patterns and least lengths of the base kinds: fixed values.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

_NAMES = ("pass", "secret", "token", "api")
_ACCOUNT = re.compile(r"""(?:user(?:_?name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{3,}""", re.ASCII | re.IGNORECASE)
_ACCOUNT_NAMES = ("user", "login", "account", "client", "access")
_MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_BARE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+")
_URL = re.compile(r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>]{3,}""")
_HOST = re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{1,5})?(?![0-9.])")
_EMPTY_LINE = re.compile(r"\n[\x20\x09\x0B-\x0D]*\n")
WEAK_LEAST = 6

Span = tuple[int, int]


def base_spans(text: str, lower: str) -> tuple[dict[str, list[Span]], list[Span]]:
    """The base spans of each kind, and assignments that are too short to be one."""
    found: dict[str, list[Span]] = {k: [] for k in BASE}
    short = []
    if any(n in lower for n in _NAMES):
        for m in _ASSIGN.finditer(text):
            n = m.end(2) - m.start(2)
            if n >= ASSIGN_LEAST:
                found["assign"].append(m.span())
            elif n >= WEAK_LEAST:
                short.append(m.span())
    if "AKIA" in text:
        found["access"] = [m.span() for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found["hex"] = [m.span() for m in _HEX.finditer(text)]
    return found, short


def _mixed(s: str) -> bool:
    return any(c.isdigit() for c in s) and any(c.islower() for c in s) and any(c.isupper() for c in s)


def _apart(spans: list[Span], taken: list[Span]) -> list[Span]:
    """Those of ``spans`` that overlap none of the sorted ``taken``, nor an earlier one of themselves."""
    ends, out, last = [b for _, b in taken], [], -1
    for a, b in sorted(spans):
        i = bisect_right(ends, a)
        if a >= last and (i == len(taken) or taken[i][0] >= b):
            out.append((a, b))
            last = b
    return out


def _union(spans: list[Span]) -> list[Span]:
    out: list[Span] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class _Parts:
    """Disjoint spans of one kind, to be asked which scopes they touch."""

    def __init__(self, spans: list[Span]):
        spans = _union(spans)
        self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]

    def touch(self, scope: Span) -> bool:
        i = bisect_right(self.ends, scope[0])
        return i < len(self.starts) and self.starts[i] < scope[1]


def candidates(text: str, lower: str, base: dict[str, list[Span]], short: list[Span]) -> tuple[list[Span], list[Span], list[Span]]:
    """Weak identifiers, secrets and endpoints, which overlap neither base spans nor one another."""
    taken = _union([s for k in BASE for s in base[k]])
    ids = [m.span() for m in _ACCOUNT.finditer(text)] if any(n in lower for n in _ACCOUNT_NAMES) else []
    if "@" in text:
        ids += [m.span() for m in _MAIL.finditer(text)]
    if "AKIA" in text:
        ids += [m.span() for m in _ACCESS.finditer(text) if ACCESS_LEAST > m.end() - m.start() >= 8]
    ends = [m.span() for m in _URL.finditer(text)] if "://" in text else []
    ends += [m.span() for m in _HOST.finditer(text) if all(int(x) < 256 for x in m[0].split(":")[0].split("."))]
    # Without an identifier or an endpoint nothing is linked; bare secrets need not be looked for.
    if not (ids or ends or base["access"]):
        return [], [], []
    keys = short + [m.span() for m in _BARE.finditer(text) if _mixed(m[0])]
    ids = _apart(ids, taken)
    keys = _apart(keys, _union(taken + ids))
    return ids, keys, _apart(ends, _union(taken + ids + keys))


def linked_spans(text: str, lower: str, base: dict[str, list[Span]], short: list[Span]) -> dict[str, list[Span]]:
    """The candidates in whose scopes complementary parts lie."""
    ids, keys, ends = candidates(text, lower, base, short)
    if not (ids or keys or ends):
        return {}
    breaks = [m.start() for m in _EMPTY_LINE.finditer(text)]

    def scope(s: Span) -> Span:
        i = bisect_left(breaks, s[0])
        low = breaks[i - 1] + 1 if i else 0
        high = breaks[i] + 1 if i < len(breaks) else len(text)
        return max(low, s[0] - REACH), min(high, s[1] + REACH)

    # A run of decimal digits alone is a number rather than a secret.
    lettered = [(a, b) for a, b in base["hex"] if not text[a:b].isdigit()]
    id_, key, end = _Parts(ids + base["access"]), _Parts(keys + base["assign"] + lettered), _Parts(ends)
    return {
        "link_id": [s for s in ids if key.touch(scope(s))],
        "link_secret": [s for s in keys if id_.touch(scope(s)) or end.touch(scope(s))],
        "link_endpoint": [s for s in ends if id_.touch(scope(s)) and key.touch(scope(s))],
    }


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a text, in order."""
    lower = text.lower()
    base, short = base_spans(text, lower)
    found = base | linked_spans(text, lower, base, short)
    flat = [(a, KINDS.index(k), b) for k, spans in found.items() for a, b in spans]
    return [(KINDS[k], a, b) for a, k, b in sorted(flat)]


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def scan(docs: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` with the array of their texts' spans added or replaced."""
    docs = docs.drop(name)
    at = docs.columns.index(text)
    schema = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in docs.schema.fields), T.StructField(name, SPANS)])
    names = [f.name for f in schema.fields]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                spans = [[{"kind": n, "start": a, "end": b} for n, a, b in spans_of(t or "")] for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, kind)], names=names)

    return docs.mapInArrow(find, schema)
