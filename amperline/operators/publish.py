"""Envelopes, replay plans and dead letters for the bus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amperline.operators.gold import location_key
from amperline.sources.schemas import EVENT_KINDS, EVENT_VERSION, topic

_ISO = "yyyy-MM-dd'T'HH:mm:ss"


def iso(moment: Column, zone: str = "") -> Column:
    return F.concat(F.date_format(moment, _ISO), F.lit(zone))


def source_fields(source: str) -> tuple[Column, Column]:
    """Partition key and source timestamp of a normalised record."""
    if source == "eia":
        return F.col("respondent"), iso(F.col("period"))
    if source == "nws":
        return location_key(), iso(F.col("period_start"), "+00:00")
    confirmed = F.date_format("date_last_confirmed", "yyyy-MM-dd")
    return F.col("state"), F.coalesce(iso(F.col("updated_at"), "+00:00"), confirmed)


def sorted_json(columns: dict[str, Column]) -> Column:
    """Compact JSON with sorted keys; NULL fields are written as null."""
    fields = [columns[name].alias(name) for name in sorted(columns)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def envelopes(
    records: DataFrame, source: str, emitted_at, *, replay: bool = False, event_id: Column | None = None
) -> DataFrame:
    """Normalised records of one source as ready envelopes.

    ``event_id`` defaults to a random UUID; pass a deterministic column to make
    a retried publish produce the same ids.
    """
    dataset, event_type = EVENT_KINDS[source]
    partition_key, source_timestamp = source_fields(source)
    payload = F.struct(*[F.col(name) for name in sorted(records.columns)])
    return records.select(
        (event_id if event_id is not None else F.expr("uuid()")).alias("event_id"),
        F.lit(EVENT_VERSION).alias("event_version"),
        F.lit(source).alias("source"),
        F.lit(dataset).alias("dataset"),
        F.lit(event_type).alias("event_type"),
        partition_key.alias("partition_key"),
        (emitted_at if isinstance(emitted_at, Column) else F.lit(emitted_at)).alias("emitted_at"),
        F.lit(replay).alias("replay"),
        source_timestamp.alias("source_timestamp"),
        payload.alias("payload"),
    )


def bus_messages(ready: DataFrame, topic_name: str) -> DataFrame:
    """Key, value and topic columns as the bus sink expects them."""
    if not topic_name.strip():
        raise ValueError("topic must not be empty")
    value = sorted_json({name: F.col(name) for name in ready.columns})
    return ready.select(
        F.lit(topic_name).alias("topic"),
        F.col("partition_key").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
    )


def replay_order(records: DataFrame) -> DataFrame:
    """Deterministic event-time order as a distributed sort."""
    return records.orderBy("period", "respondent", "record_type")


def replay_gaps(records: DataFrame, speed: float) -> DataFrame:
    """Every distinct period with its replay delay after the previous one.

    The previous period is looked up inside its own day, and across days from
    the newest period of the preceding day that has any, so no window spans all
    periods.
    """
    if speed <= 0:
        raise ValueError("speed must be greater than zero")
    periods = records.select("period").distinct().withColumn("day", F.to_date("period"))
    days = periods.groupBy("day").agg(F.max("period").alias("day_last"))
    by_year = Window.partitionBy(F.year("day")).orderBy("day")
    years = days.groupBy((F.year("day")).alias("year")).agg(F.max("day_last").alias("year_last"))
    before_year = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    carried = years.select("year", F.max("year_last").over(before_year).alias("year_before"))
    previous_day = (
        days.withColumns({"in_year": F.lag("day_last").over(by_year), "year": F.year("day")})
        .join(carried, "year")
        .select("day", F.coalesce("in_year", "year_before").alias("day_before"))
    )
    inside = Window.partitionBy("day").orderBy("period")
    previous = F.coalesce(F.lag("period").over(inside), F.col("day_before"))
    seconds = F.unix_micros("period") - F.unix_micros("previous_period")
    return (
        periods.join(previous_day, "day")
        .withColumn("previous_period", previous)
        .select(
            "period",
            "previous_period",
            F.when(
                F.col("previous_period").isNotNull(),
                F.greatest(seconds / F.lit(1e6), F.lit(0.0)) / F.lit(float(speed)),
            ).alias("delay_seconds"),
        )
    )


def replay_plan(records: DataFrame, emitted_at, speed: float, event_id: Column | None = None) -> DataFrame:
    """Historical records as ordered, replay-tagged envelopes with their delay.

    The delay sits on every record of a period; the publisher waits once.
    """
    tagged = envelopes(records, "eia", emitted_at, replay=True, event_id=event_id).withColumns(
        {
            "period": F.col("payload.period"),
            "respondent": F.col("payload.respondent"),
            "record_type": F.col("payload.record_type"),
        }
    )
    return replay_order(tagged.join(replay_gaps(records, speed), "period"))


def dead_letters(
    invalid: DataFrame, failed_at: Column, namespace: str, event_id: Column | None = None
) -> DataFrame:
    """Rejected bus records wrapped as platform envelopes.

    ``invalid`` is the invalid side of ``parse_envelopes``.
    """
    original = F.struct(
        F.col("topic").alias("original_topic"),
        F.col("partition").alias("original_partition"),
        F.col("offset").alias("original_offset"),
        F.col("validation_error").alias("failure_reason"),
        failed_at.cast("string").alias("failed_at"),
        F.col("kafka_key").alias("raw_key"),
        F.col("event_json").alias("raw_value"),
    )
    envelope = {
        "event_id": event_id if event_id is not None else F.expr("uuid()"),
        "event_version": F.lit(EVENT_VERSION),
        "source": F.lit("platform"),
        "dataset": F.lit(f"{namespace}_dead_letter"),
        "event_type": F.lit(f"{namespace}.dead_letter"),
        "partition_key": F.col("topic"),
        "emitted_at": failed_at.cast("string"),
        "replay": F.lit(False),
        "source_timestamp": F.lit(None).cast("string"),
        "payload": original,
    }
    return invalid.select(
        F.lit(topic("dead_letter", namespace)).alias("topic"),
        F.col("topic").cast("binary").alias("key"),
        sorted_json(envelope).cast("binary").alias("value"),
    )
