"""One run: fetch, pick what is to be read, detect, merge, compact, publish."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import rules
from tidemill.operators import caching, retries, scanning
from tidemill.scratch import mark, release, written
from tidemill.sources import landing, publish, reading, state


@dataclass(frozen=True)
class Config:
    """Where a run reads and writes, and how much it reads."""

    state_root: str
    out: str
    budget: int = 500
    used: tuple[rules.Rule, ...] = rules.RULES
    #: Larger results are published as many files.
    most_rows: int = publish.MOST_ROWS
    #: Postings without a text are read at their address, if it is of one of these hosts.
    hosts: tuple[str, ...] = ()
    #: A run fails when more than this share of the records has no id.
    most_without_id: float = 0.1


@dataclass(frozen=True)
class Report:
    read: int
    unread: int
    published: bool
    #: Records that have no id, and so can't be kept.
    without_id: int = 0


class TooManyWithoutId(ValueError):
    """More of the records have no id than a run takes; nothing is published."""


def content_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def identified(postings: DataFrame) -> DataFrame:
    """One row per posting, the latest, with a hash of what is read; postings without an id can't be kept."""
    known = postings.filter("posting_id is not null").withColumn("content_hash", content_hash(F.col("text")))
    return caching.latest(known, ["posting_id"], ["updated_at", "content_hash", "url", "title"])


def scan(picked: DataFrame, cfg: Config, now: datetime) -> DataFrame:
    """State rows of the postings picked; a posting without text is counted as an attempt."""
    found = scanning.findings(picked if "unread_why" in picked.columns else picked.withColumn("unread_why", F.lit(None).cast("string")), "text", cfg.used)
    ok = F.col("text").isNotNull()
    return found.select(
        "posting_id", "content_hash", "rules_version", F.lit(now).alias("scanned_at"), F.when(ok, "read").when(F.col("unread_why") == reading.TOO_LARGE, "too large").otherwise("failed").alias("status"),
        (F.coalesce("attempts", F.lit(0)) + 1).cast("int").alias("attempts"), "sponsorship_barrier", "agent_directed", "pay", "evidence",
    )


def tagged(postings: DataFrame, known: DataFrame, cfg: Config) -> DataFrame:
    """The postings with the state's status, attempts and time of reading; null where it does not know this content by these rules.

    They are joined by the id alone, of which the state has one row each: ``identified`` has dealt the
    postings by it already, so that their texts do not move again.
    """
    columns = ["status", "attempts", "scanned_at"]
    fresh = known.filter(F.col("rules_version") == rules.version(cfg.used)).select("posting_id", F.col("content_hash").alias("_hash"), *columns)
    joined = postings.join(fresh, "posting_id", "left")
    return joined.withColumns({c: F.when(F.col("_hash") == F.col("content_hash"), F.col(c)) for c in columns}).drop("_hash")


def pending(postings: DataFrame, now: datetime) -> DataFrame:
    """Those of the tagged postings that are to be read: not known; or failed, and due again after a pause that grows."""
    again = retries.due(F.col("attempts"), F.col("scanned_at")) <= F.lit(now)
    return postings.filter(F.col("status").isNull() | ((F.col("status") == "failed") & again))


def first(todo: DataFrame, waiting: int, budget: int) -> DataFrame:
    """The next ``budget`` of the postings waiting: those never tried come first, so that failures do not starve the rest.

    Where all are read, none is sorted.  Else the last one's place is found without the texts, and the rows up
    to it are kept where they are; so no task holds all that are read.
    """
    if waiting <= budget:
        return todo
    if budget < 1:
        return todo.limit(0)
    places = todo.select(F.coalesce("attempts", F.lit(0)).alias("_tried"), F.col("updated_at").alias("_updated"), F.col("posting_id").alias("_id"))
    ordered = scanning.ranked(places, [F.col("_tried"), F.col("_updated").desc_nulls_last(), F.col("_id")], "_rank")
    last = F.broadcast(ordered.filter(F.col("_rank") == budget).drop("_rank"))
    tried = F.coalesce("attempts", F.lit(0))
    # Among structs a null comes before all values.
    mine, its = F.struct(F.col("updated_at").alias("at")), F.struct(F.col("_updated").alias("at"))
    before = (tried < F.col("_tried")) | ((tried == F.col("_tried")) & ((mine > its) | ((mine == its) & (F.col("posting_id") <= F.col("_id")))))
    return todo.crossJoin(last).filter(before).select(*todo.columns)


def compact(postings: DataFrame, known: DataFrame, cfg: Config) -> DataFrame:
    """The listing: postings with what current rules found in their current text; null where not read yet."""
    fresh = known.filter((F.col("rules_version") == rules.version(cfg.used)) & (F.col("status") == "read"))
    kept = fresh.select("posting_id", "content_hash", "sponsorship_barrier", "agent_directed", "pay")
    return caching.enrich(postings, kept, ["posting_id", "content_hash"]).select("posting_id", "url", "title", "sponsorship_barrier", "agent_directed", "pay")


def run_once(spark: SparkSession, postings: DataFrame, cfg: Config, now: datetime | None = None) -> Report:
    """Read the next ``budget`` postings, save the state and publish what changed.

    Where the published cache was deleted, everything is read anew.  What the run wrote to the
    scratch folder is gone afterwards.
    """
    since = mark()
    try:
        return _run(spark, postings, cfg, now or datetime.now(UTC).replace(tzinfo=None))
    finally:
        release(spark, since, keep=0)


def _run(spark: SparkSession, postings: DataFrame, cfg: Config, now: datetime) -> Report:
    seen = Observation()
    postings = postings.observe(seen, F.count("*").alias("n"), F.count_if(F.col("posting_id").isNull()).alias("without_id"))
    cold = publish.cache_deleted(spark, cfg.out)
    known = state.load(spark, cfg.state_root).limit(0) if cold else state.load(spark, cfg.state_root)
    # The one table of a run that holds the texts.
    postings = written(tagged(identified(postings), known, cfg), "postings", "zstd")
    without_id = seen.get["without_id"]
    if without_id > cfg.most_without_id * seen.get["n"]:
        raise TooManyWithoutId(f"{without_id} of {seen.get['n']} records have no id")
    todo = pending(postings, now)
    waiting = todo.count()
    picked = first(todo, waiting, cfg.budget).drop("status", "scanned_at")
    if cfg.hosts:
        picked = reading.with_texts(picked, cfg.hosts)
    fresh = written(scan(picked, cfg, now), "fresh")
    n = fresh.count()
    merged = caching.upsert(known, fresh, ["posting_id"], ["scanned_at", "content_hash", "rules_version", "status", "attempts"])
    merged = written(caching.evict(merged, postings, ["posting_id"]), "merged")
    if cold or n or merged.count() != known.count():
        state.save(merged, cfg.state_root)
    listing = written(compact(postings, merged, cfg), "listing")
    done = publish.publish(listing, merged.drop("scanned_at"), cfg.out, ["posting_id"], cfg.most_rows)
    return Report(n, waiting - n, done, without_id)


def run_file(spark: SparkSession, path: str, cfg: Config, now: datetime | None = None) -> Report:
    """A run over one landed snapshot; a cut-off file fails before anything is published."""
    return run_once(spark, landing.read_snapshot(spark, path), cfg, now)


def tick(spark: SparkSession, url: str, folder: str, cfg: Config, hosts: tuple[str, ...], now: datetime | None = None) -> Report:
    """What a scheduler calls every 15 minutes: fetch what changed, then run over the current snapshot.

    While upstream does not change, runs go on over the snapshot that is there, so that what is unread
    is read, a budget at a time.
    """
    last = landing.current(spark, folder)
    landing.fetch(spark, url, folder, hosts, last["validator"] if last else None)
    report = run_file(spark, landing.current(spark, folder)["path"], cfg, now)
    landing.forget(spark, folder)
    return report
