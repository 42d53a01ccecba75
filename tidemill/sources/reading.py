"""Reading postings at their addresses: named hosts only, bounded in size, time and attempts.

What is read is text to be scanned, and nothing in it is followed: neither redirects to other hosts
nor anything that it says.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.pages import page_text

#: Pages are read in pieces; one that is larger than this is told apart from those that can't be read.
MOST_BYTES, PIECE_BYTES, TIMEOUT_S = 64 << 20, 1 << 20, 20
TOO_LARGE = "too large"
ATTEMPTS, BACKOFF_S = 3, 0.5
#: So many tasks read at a time, at most.
READERS = 16


class _SameHosts(urllib.request.HTTPRedirectHandler):
    def __init__(self, hosts: tuple[str, ...]):
        self.hosts = hosts

    def redirect_request(self, req, fp, code, msg, headers, newurl):
        return super().redirect_request(req, fp, code, msg, headers, newurl) if allowed(newurl, self.hosts) else None


def allowed(url: str | None, hosts: tuple[str, ...]) -> bool:
    parts = urlparse(url or "")
    return parts.scheme in ("http", "https") and parts.hostname in hosts


def read(url: str | None, hosts: tuple[str, ...], attempts: int = ATTEMPTS, backoff: float = BACKOFF_S) -> str | None:
    """The body at an address, or null if it can't be had."""
    return body_of(url, hosts, attempts, backoff)[0]


def body_of(url: str | None, hosts: tuple[str, ...], attempts: int = ATTEMPTS, backoff: float = BACKOFF_S) -> tuple[str | None, str | None]:
    """The body at an address, or why it can't be had; servers' faults are tried again, after longer and longer pauses."""
    if not allowed(url, hosts):
        return None, "not allowed"
    why = None
    opener = urllib.request.build_opener(_SameHosts(hosts))
    for turn in range(attempts):
        try:
            with opener.open(url, timeout=TIMEOUT_S) as answer:
                body = bytearray()
                while piece := answer.read(PIECE_BYTES):
                    body += piece
                    if len(body) > MOST_BYTES:
                        return None, TOO_LARGE
            return body.decode("utf-8", "replace"), None
        except urllib.error.HTTPError as e:
            why = f"status {e.code}"
            if e.code < 500 and e.code != 429:
                return None, why
        except (OSError, ValueError) as e:
            why = type(e).__name__
        if turn + 1 < attempts:
            time.sleep(backoff * 2**turn)
    return None, why


def with_texts(postings: DataFrame, hosts: tuple[str, ...]) -> DataFrame:
    """The postings, those without a text with that of the page at their address; null where it can't be read, ``unread_why`` says why.

    The postings are the slice of a run, so there are no more than its budget.
    """
    schema = T.StructType([T.StructField("posting_id", T.StringType()), T.StructField("_html", T.StringType()), T.StructField("unread_why", T.StringType())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays([row.column(0), *(pa.array([x], pa.string()) for x in body_of(row.column(1)[0].as_py(), hosts))], names=schema.names)

    missing = postings.filter(F.col("text").isNull()).select("posting_id", "url").repartition(READERS)
    found = missing.mapInArrow(fetch, schema)
    return postings.join(found, "posting_id", "left").withColumn("text", F.coalesce("text", page_text(F.col("_html")))).drop("_html")
