"""Bronze: decode bus records into validated event envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.functions.parsing import parsed_once
from amperline.functions.rules import blank, first_failure, missing, not_exactly
from amperline.sources.schemas import ENVELOPE, EVENT_SOURCES, EVENT_VERSION


def envelope_rules():
    """The nine envelope rules; the order decides which code is reported."""
    return [
        ("missing_or_invalid_event_id", blank("event_id")),
        ("unsupported_event_version", not_exactly("event_version", EVENT_VERSION)),
        ("missing_or_invalid_source", not_exactly("source", *EVENT_SOURCES)),
        ("missing_or_invalid_dataset", blank("dataset")),
        ("missing_or_invalid_event_type", blank("event_type")),
        ("missing_or_invalid_partition_key", blank("partition_key")),
        ("missing_or_invalid_emitted_at", blank("emitted_at")),
        ("missing_or_invalid_replay", missing("replay")),
        ("missing_or_invalid_payload", missing("payload_json")),
    ]


def decode_records(records: DataFrame) -> DataFrame:
    """Bus records with key and value as text."""
    return records.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("event_json"),
    )


def parse_envelopes(records: DataFrame) -> DataFrame:
    """Flatten, validate and date bus records; works on batches and streams."""
    decoded = decode_records(records)
    flat = decoded.select("*", parsed_once("event_json", ENVELOPE).alias("envelope")).select(
        *decoded.columns, "envelope.*"
    )
    return (
        flat.withColumnRenamed("payload", "payload_json")
        .withColumn("validation_error", first_failure(envelope_rules()))
        .withColumns(
            {
                "is_valid": F.col("validation_error").isNull(),
                "kafka_date": F.to_date("kafka_timestamp"),
            }
        )
    )


def valid_envelopes(parsed: DataFrame) -> DataFrame:
    return parsed.where("is_valid").drop("is_valid", "validation_error")


def invalid_envelopes(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("is_valid"))
