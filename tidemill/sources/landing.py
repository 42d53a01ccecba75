"""The snapshot source: fetch one file, land it, parse it behind a gate against cut-off input."""

from __future__ import annotations

import hashlib
import json
import urllib.error
import urllib.request
from collections.abc import Iterator
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.sources import files

#: A download goes to its file in pieces of so many bytes, and may pause for so long.
PIECE_BYTES, TIMEOUT_S = 1 << 20, 30
#: Which snapshot is the current one and what upstream calls it; readers of the folder overlook names that begin so.
CURRENT = "_CURRENT"
KEEP = 3
POSTING = T.StructType(
    [
        T.StructField("posting_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
CORRUPT = "_corrupt_record"


class CorruptSnapshot(ValueError):
    """The snapshot has records that do not parse; nothing of it may be published."""


def current(spark: SparkSession, landing: str) -> dict | None:
    """The current snapshot: its path, number, digest and validator; None before the first."""
    found = files.read_text(spark, f"{landing.rstrip('/')}/{CURRENT}")
    return json.loads(found) if found else None


def fetch(spark: SparkSession, url: str, landing: str, hosts: tuple[str, ...], validator: str | None = None) -> tuple[str | None, str | None]:
    """Download ``url`` to a new file in ``landing``: (path, validator), or (None, validator) if it has not changed.

    Only the hosts named are asked.  The body goes to the file in pieces, so it may be of any size.  A file's
    name holds its number and its digest: no two downloads share one, so a stream over the folder sees each,
    and a body like the current one's leaves no new file.
    """
    if urlparse(url).hostname not in hosts or urlparse(url).scheme not in ("http", "https"):
        raise ValueError("the address is not of a host that may be asked")
    request = urllib.request.Request(url, headers={"If-None-Match": validator} if validator else {})
    root, digest = landing.rstrip("/"), hashlib.sha256()
    arriving = f"{root}/_arriving"

    def pieces(answer) -> Iterator[bytes]:
        expected, got = answer.headers.get("Content-Length"), 0
        while piece := answer.read(PIECE_BYTES):
            digest.update(piece)
            got += len(piece)
            yield piece
        if expected is not None and got != int(expected):
            raise CorruptSnapshot(f"{url} ended after {got} of {expected} bytes")

    try:
        with urllib.request.urlopen(request, timeout=TIMEOUT_S) as answer:
            found = answer.headers.get("ETag")
            files.write_text(spark, arriving, pieces(answer))
    except urllib.error.HTTPError as e:
        if e.code == 304:
            return None, validator
        raise
    last = current(spark, root)
    same = last is not None and last["digest"] == digest.hexdigest() and files.exists(spark, last["path"])
    if same:
        files.delete(spark, arriving)
    number = last["number"] + (not same) if last else 1
    path = last["path"] if same else f"{root}/snapshot-{number:09d}-{digest.hexdigest()[:16]}.json"
    if not same:
        files.move(spark, arriving, path)
    # Path and validator move together: a validator is never kept for a body that did not land.
    files.write_text(spark, f"{root}/{CURRENT}", json.dumps({"path": path, "number": number, "digest": digest.hexdigest(), "validator": found}))
    return (None if same else path), found


def forget(spark: SparkSession, landing: str, keep: int = KEEP) -> None:
    """Delete all snapshots but the last ``keep``."""
    for name in [n for n in files.names(spark, landing) if n.startswith("snapshot-")][:-keep]:
        files.delete(spark, f"{landing.rstrip('/')}/{name}")


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType = POSTING, lines: bool = False, rest: str | None = None) -> DataFrame:
    """Postings of a JSON array (or of JSON lines), checked to be whole.

    ``rest`` names a variant column for the fields that the schema does not have, kept as each
    record's whole JSON; then the schema's fields are taken from it, null where they do not fit.
    A JSON array is parsed by one task; lines are split.
    """
    reader = spark.read.option("multiLine", not lines).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])).json(path)
    if df.filter(F.col(CORRUPT).isNotNull()).take(1):
        raise CorruptSnapshot(path)
    df = df.drop(CORRUPT)
    if rest:
        whole = spark.read.option("singleVariantColumn", rest).option("multiLine", not lines).json(path)
        if not lines:
            # A single record may stand without an array around it.
            whole = whole.select(F.explode(F.coalesce(F.expr(f"try_variant_get(`{rest}`, '$', 'array<variant>')"), F.array(rest))).alias(rest))
        own = [F.try_variant_get(F.col(rest), f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in schema.fields if f.name != rest]
        df = whole.select(*own, rest)
    return df
