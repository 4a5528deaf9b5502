"""Message outcomes by source and minute, from batches, from a stream and from a stream's own log.

A stream that processes messages notes in a log what became of them: processed, dead
lettered, or failed in the handler. The log holds counts per minute, source and
outcome. Every attempt of a micro-batch has one entry that appears whole and once, so
a second stream that sums the log counts every attempt exactly once, also after
restarts of either.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from amperline.sources.commits import listed, move_folder, remove

LOG = "minute TIMESTAMP, source STRING, outcome STRING, messages BIGINT"


def with_outcome(parsed: DataFrame) -> DataFrame:
    """Outcome of a parsed record: processed, or dead-lettered without a source."""
    return parsed.withColumns(
        {
            "outcome": F.when(F.col("is_valid"), "processed").otherwise("dead_lettered"),
            "outcome_source": F.when(F.col("is_valid"), F.col("source")).otherwise("unknown"),
        }
    )


def outcome_counts(parsed: DataFrame) -> DataFrame:
    """Totals per source and outcome."""
    return (
        with_outcome(parsed)
        .groupBy(F.col("outcome_source").alias("source"), "outcome")
        .agg(F.count("*").alias("messages"))
    )


def outcome_rate(parsed: DataFrame, width: str = "1 minute", lateness: str = "10 minutes"):
    """Messages per source, outcome and window with the rate per second.

    Works on batches and on streams; on a stream the watermark closes windows.
    """
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    labelled = with_outcome(parsed)
    if labelled.isStreaming:
        labelled = labelled.withWatermark("kafka_timestamp", lateness)
    return (
        labelled.groupBy(
            F.window("kafka_timestamp", width),
            F.col("outcome_source").alias("source"),
            "outcome",
        )
        .agg(F.count("*").alias("messages"))
        .select(
            F.col("window.start").alias("window_start"),
            "source",
            "outcome",
            "messages",
            (F.col("messages") / seconds).alias("messages_per_second"),
        )
    )


# The log of a stream -------------------------------------------------------------


class HandlerFailed(Exception):
    """Raised by a handler that could not process some rows of a batch."""

    def __init__(self, rows: DataFrame, reason: str = "handler failed") -> None:
        super().__init__(reason)
        self.rows = rows


class OutcomeLog:
    """Entries of one folder each; an entry is written aside and then given its name."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _add(self, labelled: DataFrame, entry: str) -> None:
        counts = labelled.groupBy(
            F.date_trunc("minute", "kafka_timestamp").alias("minute"), "source", "outcome"
        ).agg(F.count("*").alias("messages"))
        aside = f"{self.folder}/_aside/{uuid.uuid4().hex}"
        counts.write.parquet(aside)
        if not move_folder(self.spark, aside, f"{self.folder}/entries/{entry}"):
            remove(self.spark, aside)  # a batch that is repeated has the entry of its first end

    def done(self, parsed: DataFrame, batch: str) -> None:
        """A batch was processed; its valid rows are, the others were dead lettered."""
        labelled = with_outcome(parsed).withColumn("source", F.col("outcome_source"))
        self._add(labelled, f"{batch}-done")

    def failed(self, rows: DataFrame, batch: str) -> None:
        """An attempt of a batch ended with these rows failed; the batch will come again."""
        earlier = [e for e in listed(self.spark, f"{self.folder}/entries") if e.startswith(f"{batch}-failed-")]
        labelled = rows.withColumn("outcome", F.lit("handler_failed"))
        self._add(labelled, f"{batch}-failed-{len(earlier) + 1:06d}")

    def stream(self, lateness: str) -> DataFrame:
        """Messages per minute, source and outcome, as a stateful aggregation over the log.

        State of a minute is given up when the newest minute is ``lateness`` ahead of it.
        """
        entries = (
            self.spark.readStream.schema(LOG)
            .option("recursiveFileLookup", True)
            .parquet(f"{self.folder}/entries")
        )
        return (
            entries.withWatermark("minute", lateness)
            .groupBy(F.window("minute", "1 minute"), "source", "outcome")
            .agg(F.sum("messages").alias("messages"))
            .select(F.col("window.start").alias("window_start"), "source", "outcome", "messages")
        )


def start_totals(log: OutcomeLog, table: str, checkpoint: str, lateness: str = "1 day") -> StreamingQuery:
    """Sum what the log has got and stop; every run writes the sums that changed.

    A micro-batch that is repeated after a restart replaces its own folder.
    """

    def write(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{table}/epoch={epoch}")

    return (
        log.stream(lateness)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def read_totals(spark: SparkSession, table: str) -> DataFrame:
    """The newest sum of every minute, source and outcome, with the rate per second."""
    schema = "window_start TIMESTAMP, source STRING, outcome STRING, messages BIGINT, epoch BIGINT"
    newest = (
        spark.read.schema(schema)
        .parquet(table)
        .groupBy("window_start", "source", "outcome")
        .agg(F.max_by("messages", "epoch").alias("messages"))
    )
    return newest.withColumn("messages_per_second", F.col("messages") / F.lit(60))
