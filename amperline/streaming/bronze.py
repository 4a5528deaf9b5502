"""Bus to Bronze: one query, two tables and a dead-letter feed."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from amperline.operators.envelope import invalid_envelopes, parse_envelopes, valid_envelopes
from amperline.operators.publish import dead_letters
from amperline.session import discard, durable, scratch_folder
from amperline.sources.tables import LAYERS, exists, table_path
from amperline.streaming.outcomes import HandlerFailed, OutcomeLog


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """Name of the stream behind a checkpoint, kept in the checkpoint itself.

    Batch numbers restart at 0 with every new checkpoint, so they identify a batch
    only together with this name. It is made once and read back by later runs.
    """
    place = f"{checkpoint.rstrip('/')}/stream"
    if not exists(spark, f"{place}/_SUCCESS"):
        named = spark.range(1).select(F.lit(uuid.uuid4().hex).alias("value"))
        named.write.mode("overwrite").text(place)
    return spark.read.text(place).first()["value"]


def _replace_batch(frame: DataFrame, root: str, name: str, stream: str, batch_id: int) -> None:
    """Write one micro-batch; a repeated batch of the same stream replaces its own files."""
    partitions = LAYERS[name].partitions if name in LAYERS else ("batch_id",)
    (
        frame.withColumn("batch_id", F.lit(f"{stream}-{batch_id}"))
        .hint("rebalance", *[F.col(column) for column in partitions])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(table_path(root, name))
    )


def bronze_batch(
    root: str,
    namespace: str,
    stream: str,
    handler: Callable[[DataFrame], None] | None = None,
    outcomes: OutcomeLog | None = None,
) -> Callable[[DataFrame, int], None]:
    """Batch function: valid rows to Bronze, rejected rows to quarantine and
    dead letters. An exception, also one from ``handler``, leaves the offsets of
    the batch uncommitted, so it is delivered again. ``outcomes`` gets an entry for
    every attempt that the handler ended and for the end of the batch.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Streaming plans run without adaptive execution. The writes below are
        # plain batch jobs and need it to split hot partitions and merge small ones.
        conf = spark.conf
        adaptive = conf.get("spark.sql.adaptive.enabled")
        conf.set("spark.sql.adaptive.enabled", "true")
        # The source packs the files of a batch into about one task a core, so a cached
        # task would grow with the batch. Stored, the batch is read once and then in
        # splits of bounded size by every write below, at any size of the batch.
        folder = scratch_folder(spark)
        try:
            parsed = durable(batch, folder)
            valid, invalid = valid_envelopes(parsed), invalid_envelopes(parsed)
            if handler is not None:
                try:
                    handler(valid)
                except Exception as error:
                    if outcomes is not None:
                        rows = error.rows if isinstance(error, HandlerFailed) else valid
                        outcomes.failed(rows, f"{stream}-{batch_id}")
                    raise
            _replace_batch(valid, root, "bronze_events", stream, batch_id)
            _replace_batch(invalid, root, "bronze_quarantine", stream, batch_id)
            letters = dead_letters(
                invalid,
                F.col("kafka_timestamp"),
                namespace,
                F.concat_ws("-", F.lit("dlq"), "topic", "partition", "offset"),
            )
            _replace_batch(letters, root, "dead_letters", stream, batch_id)
            if outcomes is not None:
                outcomes.done(parsed, f"{stream}-{batch_id}")
        finally:
            conf.set("spark.sql.adaptive.enabled", adaptive)
            discard(spark, folder)

    return process


def start_bronze(
    records: DataFrame,
    root: str,
    checkpoint: str,
    *,
    namespace: str = "events",
    handler: Callable[[DataFrame], None] | None = None,
    outcomes: OutcomeLog | None = None,
) -> StreamingQuery:
    """Drain what is available and stop; the checkpoint carries on next time.

    Streams with checkpoints of their own can feed one root, none replaces rows of another.
    """
    stream = stream_identity(records.sparkSession, checkpoint)
    return (
        parse_envelopes(records)
        .writeStream.queryName("bronze")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(bronze_batch(root, namespace, stream, handler, outcomes))
        .start()
    )


def start_append(
    frame: DataFrame, path: str, checkpoint: str, partitions: tuple[str, ...] = ()
) -> StreamingQuery:
    """Plain append sink with exactly-once files, for a single output table."""
    writer = (
        frame.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.start(path)


def rows_processed(query: StreamingQuery) -> int:
    """Input rows over the recent progress reports of a query."""
    return sum(int(report["numInputRows"]) for report in query.recentProgress)
