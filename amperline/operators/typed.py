"""Silver: typed, rule-checked and deduplicated records per source."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amperline.functions.parsing import parsed_once
from amperline.functions.rules import (
    Rule,
    blank,
    missing,
    missing_or_outside,
    not_exactly,
    outside,
    with_quality,
)
from amperline.sources.schemas import (
    ELECTRICITY_PAYLOAD,
    LINEAGE_COLUMNS,
    STATION_PAYLOAD,
    WEATHER_PAYLOAD,
)

QUARANTINE_COLUMNS = (
    "source",
    "event_id",
    "event_type",
    "topic",
    "partition",
    "offset",
    "kafka_timestamp",
    "quality_error",
)


@dataclass(frozen=True)
class TypedSource:
    """How one source's payload becomes a typed table.

    ``convert`` lists the payload columns that change on the way in, every
    other payload column is taken over as parsed.
    """

    source: str
    payload: str
    columns: tuple[str, ...]
    rules: Callable[[], list[Rule]]
    business_key: tuple[str, ...]
    convert: Callable[[], dict[str, Column]] = field(default=dict)
    date_column: tuple[str, str] | None = None
    newest_by: tuple[str, ...] = ()


def _instant(name: str) -> Column:
    return F.try_to_timestamp(F.col(f"payload.{name}"))


ELECTRICITY = TypedSource(
    source="eia",
    payload=ELECTRICITY_PAYLOAD,
    columns=(
        "period_raw",
        "period",
        "record_type",
        "respondent",
        "respondent_name",
        "type_name",
        "value",
        "value_units",
    ),
    convert=lambda: {"period_raw": F.col("payload.period"), "period": _instant("period")},
    rules=lambda: [
        ("invalid_period", missing("period")),
        ("invalid_respondent", blank("respondent")),
        ("invalid_record_type", blank("record_type")),
        ("invalid_value", missing("value")),
        ("invalid_value_units", blank("value_units")),
    ],
    business_key=("period", "respondent", "record_type"),
    date_column=("period_date", "period"),
)

WEATHER = TypedSource(
    source="nws",
    payload=WEATHER_PAYLOAD,
    columns=(
        "latitude",
        "longitude",
        "period_start",
        "period_end",
        "temperature",
        "temperature_unit",
        "precipitation_probability",
        "relative_humidity",
        "wind_speed",
        "wind_direction",
        "short_forecast",
    ),
    convert=lambda: {name: _instant(name) for name in ("period_start", "period_end")},
    rules=lambda: [
        ("invalid_latitude", missing_or_outside("latitude", -90, 90)),
        ("invalid_longitude", missing_or_outside("longitude", -180, 180)),
        ("invalid_period_start", missing("period_start")),
        ("invalid_period_end", missing("period_end")),
        ("invalid_period_range", F.col("period_end") <= F.col("period_start")),
        ("invalid_temperature", missing("temperature")),
        ("invalid_temperature_unit", not_exactly("temperature_unit", "F", "C")),
        ("invalid_precipitation_probability", outside("precipitation_probability", 0, 100)),
        ("invalid_relative_humidity", outside("relative_humidity", 0, 100)),
        ("invalid_short_forecast", blank("short_forecast")),
    ],
    business_key=("latitude", "longitude", "period_start"),
    date_column=("forecast_date", "period_start"),
)

STATIONS = TypedSource(
    source="afdc",
    payload=STATION_PAYLOAD,
    columns=(
        "station_id",
        "station_name",
        "street_address",
        "city",
        "state",
        "zip_code",
        "country",
        "latitude",
        "longitude",
        "fuel_type_code",
        "access_code",
        "status_code",
        "ev_network",
        "ev_connector_types",
        "ev_level1_evse_num",
        "ev_level2_evse_num",
        "ev_dc_fast_num",
        "facility_type",
        "date_last_confirmed",
        "updated_at",
    ),
    convert=lambda: {
        "date_last_confirmed": F.col("payload.date_last_confirmed").try_cast("date"),
        "updated_at": _instant("updated_at"),
    },
    rules=lambda: [
        ("invalid_station_id", F.coalesce(F.col("station_id"), F.lit(0)) <= 0),
        ("invalid_station_name", blank("station_name")),
        ("invalid_latitude", missing_or_outside("latitude", -90, 90)),
        ("invalid_longitude", missing_or_outside("longitude", -180, 180)),
        ("invalid_state", F.length(F.trim(F.coalesce("state", F.lit("")))) != 2),
        ("invalid_fuel_type", not_exactly("fuel_type_code", "ELEC")),
        ("invalid_access_code", not_exactly("access_code", "public")),
        ("invalid_status_code", not_exactly("status_code", "E")),
    ],
    business_key=("station_id",),
    newest_by=("updated_at",),
)

TYPED_SOURCES = (ELECTRICITY, WEATHER, STATIONS)


def typed_candidates(bronze: DataFrame, spec: TypedSource) -> DataFrame:
    """Typed projection of one source with its quality verdict.

    The source filter comes first so a Bronze table partitioned by source is
    pruned before any JSON is parsed.
    """
    parsed = bronze.where(F.col("source") == spec.source).select(
        *LINEAGE_COLUMNS, parsed_once("payload_json", spec.payload).alias("payload")
    )
    converted = spec.convert()
    typed = parsed.select(
        *LINEAGE_COLUMNS,
        F.try_to_timestamp("emitted_at").alias("event_emitted_at"),
        *[converted.get(name, F.col(f"payload.{name}")).alias(name) for name in spec.columns],
    )
    if spec.date_column:
        target, origin = spec.date_column
        typed = typed.withColumn(target, F.to_date(origin))
    return with_quality(typed, spec.rules())


def latest_valid(candidates: DataFrame, spec: TypedSource) -> DataFrame:
    """Newest valid record per business key.

    The rank filter sits directly on the window, so Spark keeps one row per key
    in every map task before the shuffle; a hot key cannot fill a partition.
    """
    newest = Window.partitionBy(*spec.business_key).orderBy(
        *[F.col(name).desc_nulls_last() for name in spec.newest_by],
        F.col("event_emitted_at").desc_nulls_last(),
        F.col("kafka_timestamp").desc_nulls_last(),
        F.col("partition").desc(),
        F.col("offset").desc(),
    )
    return (
        candidates.where("is_valid")
        .withColumn("recency", F.row_number().over(newest))
        .where("recency = 1")
        .drop("recency")
    )


def quarantined(candidates: dict[str, DataFrame]) -> DataFrame:
    """Rejected records of all sources in one common shape."""
    parts = [
        frame.where(~F.col("is_valid"))
        .withColumn("source", F.lit(source))
        .select(*QUARANTINE_COLUMNS)
        for source, frame in candidates.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def electricity(bronze: DataFrame) -> DataFrame:
    return typed_candidates(bronze, ELECTRICITY)


def weather(bronze: DataFrame) -> DataFrame:
    return typed_candidates(bronze, WEATHER)


def stations(bronze: DataFrame) -> DataFrame:
    return typed_candidates(bronze, STATIONS)
