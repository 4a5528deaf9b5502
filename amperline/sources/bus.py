"""The event bus: Kafka where its connector is present, topic folders otherwise."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.sources.schemas import RECORD


def kafka_stream(spark: SparkSession, servers: str, topics: list[str]) -> DataFrame:
    """Streaming read of several topics from their earliest offsets."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .load()
    )


def kafka_batch(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    starts: dict[str, dict[int, int]] | None = None,
    ends: dict[str, dict[int, int]] | None = None,
) -> DataFrame:
    """Bounded read, by default from the earliest to the latest offsets.

    ``starts`` and ``ends`` give offsets by topic and partition; the record at the end
    is not read.
    """

    def written(offsets: dict[str, dict[int, int]]) -> str:
        return json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in offsets.items()})

    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", written(starts) if starts else "earliest")
        .option("endingOffsets", written(ends) if ends else "latest")
        .load()
    )


def offset_ranges(records: DataFrame) -> DataFrame:
    """First offset, offset after the last and number of records of every topic partition.

    Of the records only topic, partition and offset are read, no key and no payload.
    ``span`` is what the offsets alone say: it exceeds ``records`` where a topic was
    compacted or offsets belong to transactions.
    """
    return (
        records.groupBy("topic", "partition")
        .agg(
            F.min("offset").alias("start_offset"),
            (F.max("offset") + 1).alias("end_offset"),
            F.count("*").alias("records"),
        )
        .withColumn("span", F.col("end_offset") - F.col("start_offset"))
    )


def within(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """Records whose offset lies in the range of their topic partition, ends left out.

    The same bounded read as ``kafka_batch`` with offsets, for topic folders.
    """
    limits = ranges.select("topic", "partition", "start_offset", "end_offset")
    inside = (F.col("offset") >= F.col("start_offset")) & (F.col("offset") < F.col("end_offset"))
    return records.join(limits, ["topic", "partition"]).where(inside).select(*records.columns)


def folder_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Streaming read of a folder of Parquet files shaped like bus records."""
    return (
        spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def folder_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORD).parquet(path)


def peek(records: DataFrame, rows: int = 5) -> DataFrame:
    """A few decoded records, for a connectivity check."""
    return records.selectExpr(
        "topic",
        "partition",
        "offset",
        "timestamp AS kafka_timestamp",
        "CAST(key AS STRING) AS event_key",
        "CAST(value AS STRING) AS event_json",
    ).limit(rows)


def send_to_kafka(messages: DataFrame, servers: str) -> None:
    """Publish ``topic``, ``key`` and ``value`` rows."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
