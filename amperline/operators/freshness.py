"""Freshness of each source's mart at a given moment."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.functions.clock import hours_between, instant
from amperline.functions.numeric import shown


@dataclass(frozen=True)
class FreshnessRule:
    """Which timestamp of which mart speaks for a source, and its two limits."""

    source: str
    display_name: str
    dataset: str
    table: str
    timestamps: tuple[str, ...]
    fresh_hours: float
    stale_hours: float


# Sources, timestamp preference and limits in hours.
FRESHNESS_RULES = (
    FreshnessRule(
        "eia",
        "EIA Grid",
        "Electricity regional operations",
        "mart_grid_hourly",
        ("kafka_timestamp", "source_timestamp", "period"),
        6.0,
        24.0,
    ),
    FreshnessRule(
        "nws",
        "NWS Weather",
        "Hourly weather forecast",
        "mart_weather_forecast",
        ("kafka_timestamp", "period_start"),
        6.0,
        24.0,
    ),
    FreshnessRule(
        "afdc",
        "AFDC EV",
        "EV charging infrastructure",
        "mart_ev_city_rankings",
        ("latest_kafka_timestamp", "kafka_timestamp", "latest_station_update"),
        48.0,
        168.0,
    ),
)
TIMESTAMP_BASIS = {
    "kafka_timestamp": "Kafka event timestamp",
    "latest_kafka_timestamp": "Latest Kafka event timestamp",
    "source_timestamp": "Upstream source timestamp",
    "period": "Latest analytical period",
    "period_start": "Forecast period start",
    "latest_station_update": "Latest station update",
}
NO_BASIS = "No supported timestamp column"


def _newest_timestamp(spark, rule: FreshnessRule, table: DataFrame | None) -> DataFrame:
    columns = set(table.columns) if table is not None else set()
    chosen = next((name for name in rule.timestamps if name in columns), None)
    if chosen is None:
        latest = spark.range(1).select(F.lit(None).cast("timestamp").alias("latest_timestamp"))
        basis = NO_BASIS
    else:
        kind = dict(table.dtypes)[chosen]
        moment = F.col(chosen)
        moment = F.try_to_timestamp(moment) if kind == "string" else moment.cast("timestamp")
        latest = table.agg(F.max(moment).alias("latest_timestamp"))
        basis = TIMESTAMP_BASIS[chosen]
    return latest.select(
        F.lit(rule.source).alias("source"),
        F.lit(rule.display_name).alias("display_name"),
        F.lit(rule.dataset).alias("dataset"),
        "latest_timestamp",
        F.lit(basis).alias("timestamp_basis"),
        F.lit(rule.fresh_hours).alias("fresh_within_hours"),
        F.lit(rule.stale_hours).alias("stale_after_hours"),
    )


def source_freshness(
    spark,
    tables: dict[str, DataFrame | None],
    now,
    rules: tuple[FreshnessRule, ...] = FRESHNESS_RULES,
) -> DataFrame:
    """State and age of every source; a missing table is UNKNOWN."""
    newest = reduce(
        DataFrame.unionByName,
        [_newest_timestamp(spark, rule, tables.get(rule.table)) for rule in rules],
    )
    age = hours_between(F.col("latest_timestamp"), instant(now))
    return (
        newest.withColumn("age", F.when(F.col("latest_timestamp").isNotNull(), age))
        .withColumns(
            {
                "state": F.when(F.col("age").isNull(), "UNKNOWN")
                .when(F.col("age") <= F.col("fresh_within_hours"), "FRESH")
                .when(F.col("age") <= F.col("stale_after_hours"), "DELAYED")
                .otherwise("STALE"),
                "age_hours": shown("age", 2),
            }
        )
        .drop("age")
    )


def freshness_counts(signals: DataFrame) -> DataFrame:
    return signals.groupBy("state").agg(F.count("*").alias("sources"))
