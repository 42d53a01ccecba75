"""Runs as a stream: each landed snapshot is one micro-batch of the same functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemill.plans.run import Config, run_file, run_once
from tidemill.sources.landing import CORRUPT, POSTING, CorruptSnapshot
from tidemill.sources.snapshots import NAME, Snapshots

CADENCE = "15 minutes"


def start(spark: SparkSession, landing: str, checkpoint: str, cfg: Config, resident: bool = False) -> StreamingQuery:
    """Run once for each snapshot in ``landing`` that has not been seen, oldest first.

    By default the query drains what is there and ends; a resident one looks every 15 minutes.
    A snapshot that does not parse stops the query before anything of it is published.
    """
    schema = T.StructType([*POSTING.fields, T.StructField(CORRUPT, T.StringType())])
    source = spark.readStream.schema(schema).option("multiLine", True).option("maxFilesPerTrigger", 1).option("columnNameOfCorruptRecord", CORRUPT).json(landing)

    def each(batch: DataFrame, _: int) -> None:
        if batch.filter(F.col(CORRUPT).isNotNull()).take(1):
            raise CorruptSnapshot(landing)
        run_once(batch.sparkSession, batch.drop(CORRUPT), cfg)

    writer = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=CADENCE) if resident else writer.trigger(availableNow=True)).start()


def follow(spark: SparkSession, folder: str, checkpoint: str, cfg: Config, resident: bool = False) -> StreamingQuery:
    """Run over the latest of the snapshots that have landed since, each time there are new ones.

    Offsets are the numbers of snapshots, so each counts once over restarts; those overtaken between two
    looks are not run over.  A snapshot that does not parse stops the query before anything of it is published.
    """
    spark.dataSource.register(Snapshots)
    landed = spark.readStream.format(NAME).option("path", folder).load()

    def each(batch: DataFrame, _: int) -> None:
        last = batch.agg(F.max_by("path", "number")).first()[0]
        if last is not None:
            run_file(batch.sparkSession, last, cfg)

    writer = landed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=CADENCE) if resident else writer.trigger(availableNow=True)).start()


def arrivals(events: DataFrame, late: str = "1 hour", every: str = CADENCE) -> DataFrame:
    """(start, n): events per window of event time; works on streams and tables alike."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("ts", late)
    return timed.groupBy(F.window("ts", every)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")
