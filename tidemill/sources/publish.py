"""The sink: one JSON array for consumers that poll, published only when it changed.

A release is a folder with the listing and the scan cache, named by their fingerprints; the pointer
moves when all of it is there, so a reader who follows it never sees a new listing with old
findings.  The last ``KEEP`` releases stay.  Results of up to ``MOST_ROWS`` rows are single files, which
also have fixed names, for consumers that know only those; such names are replaced one after the
other, the cache first, so a plain consumer of both may see a cache that is newer than its listing.
Larger results are JSON lines in many files; the fixed names then hold a manifest, a JSON object with the number
of rows and the files' places under the published folder.

All files of a release are written by tasks; the driver writes marks and pointers.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.compacting import as_json, fingerprint
from tidemill.sources import files

LISTING, CACHE, MARK, POINTER = "listing.json", "scan-cache.json", "fingerprint.txt", "CURRENT"
MANIFEST = ".parts.json"
#: A single file is meant for consumers of small results; larger ones are written as parts.
MOST_ROWS = 1_000_000
KEEP = 3


def write_array(df: DataFrame, order: list[str], path: str, n: int) -> None:
    """Write the ``n`` rows in order as one JSON array: a sorted partition by a task, moved over ``path``."""
    spark = df.sparkSession
    if not n:
        files.write_text(spark, path, "[\n]\n")
        return
    rows = df.select(*order, as_json(df.columns).alias("_json")).orderBy(*order).coalesce(1).withColumn("_at", F.monotonically_increasing_id())
    lines = F.concat(F.when(F.col("_at") == 0, "[\n").otherwise(","), "_json", F.when(F.col("_at") == n - 1, "\n]").otherwise(""))
    rows.select(lines.alias("value")).write.mode("overwrite").text(f"{path}.parts")
    (part,) = (x for x in files.names(spark, f"{path}.parts") if x.startswith("part-"))
    files.move(spark, f"{path}.parts/{part}", path)
    files.delete(spark, f"{path}.parts")


def write_lines(df: DataFrame, path: str) -> None:
    """Write the rows as JSON lines in many files."""
    df.select(as_json(df.columns).alias("value")).write.mode("overwrite").text(path)


def _name(mark: str) -> str:
    return f"{mark[:16]}{mark[64:80]}"


def manifest(spark: SparkSession, out: str, release: str, name: str, rows: int) -> str:
    """What a consumer needs to read a result of many files: the rows and the files, as many as tasks wrote."""
    at = f"releases/{release}/{name}"
    return json.dumps({"rows": rows, "parts": [f"{at}/{n}" for n in files.names(spark, f"{out}/{at}") if n.startswith("part-")]})


def publish(listing: DataFrame, cache: DataFrame, out: str, order: list[str], most_rows: int = MOST_ROWS) -> bool:
    """Publish both tables if either changed; whether it did."""
    spark = listing.sparkSession
    n, mark = fingerprint(listing, listing.columns).first()
    m, other = fingerprint(cache, cache.columns).first()
    both = f"{mark}{other}"
    if files.read_text(spark, f"{out}/{MARK}") == both:
        return False
    release, single = f"{out}/releases/{_name(both)}", max(n, m) <= most_rows
    files.delete(spark, release)  # of a run that died before it moved the pointer
    for df, name, rows in ((listing, LISTING, n), (cache, CACHE, m)):
        if single:
            write_array(df, order, f"{release}/{name}", rows)
        else:
            write_lines(df, f"{release}/{name}")
            files.write_text(spark, f"{release}/{name}{MANIFEST}", manifest(spark, out, _name(both), name, rows))
    last = files.read_text(spark, f"{out}/{POINTER}")
    files.write_text(spark, f"{out}/{POINTER}", _name(both))
    for name in (CACHE, LISTING):
        files.copy(spark, f"{release}/{name}{'' if single else MANIFEST}", f"{out}/{name}")
    files.write_text(spark, f"{out}/{MARK}", both)
    _forget(spark, out, _name(both), last)
    return True


def _forget(spark: SparkSession, out: str, *stay: str | None) -> None:
    """Delete all releases but the last KEEP, of which ``stay`` are some."""
    old = files.by_age(spark, f"{out}/releases")
    for name in old[:-KEEP]:
        if name not in stay:
            files.delete(spark, f"{out}/releases/{name}")


def cache_deleted(spark: SparkSession, out: str) -> bool:
    """Whether something was published, and its cache was deleted since: then everything is to be read anew."""
    return files.read_text(spark, f"{out}/{MARK}") is not None and not files.exists(spark, f"{out}/{CACHE}")


def read_listing(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The published listing as a table, whether it is one file or many."""
    path = f"{out}/releases/{files.read_text(spark, f'{out}/{POINTER}')}/{LISTING}"
    return spark.read.schema(schema).option("multiLine", not files.is_folder(spark, path)).json(path)


def read_if_changed(spark: SparkSession, out: str, seen: str | None) -> tuple[str | None, str | None]:
    """What a polling consumer does: (listing, mark), or (None, mark) while the mark is the one it has seen.

    The listing is that of the mark, even if another is published meanwhile: a JSON array of its rows or,
    of a large one, the manifest of its parts.
    """
    while True:
        mark = files.read_text(spark, f"{out}/{MARK}")
        if mark is None or mark == seen:
            return None, mark
        at = f"{out}/releases/{_name(mark)}/{LISTING}"
        body = files.read_text(spark, f"{at}{MANIFEST}" if files.is_folder(spark, at) else at)
        if body is not None:
            return body, mark
        if files.read_text(spark, f"{out}/{MARK}") == mark:
            raise FileNotFoundError(f"the release of {out} is gone")
