"""Gold: one row per hour and respondent, forecast hour, or city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperline.functions.numeric import percent_of

# Record type codes and precipitation bands.
RECORD_TYPES = {
    "D": "demand_mwh",
    "DF": "demand_forecast_mwh",
    "NG": "net_generation_mwh",
    "TI": "total_interchange_mwh",
}
PRECIPITATION_BANDS = (("low", 20), ("moderate", 50))


def passing(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("quality_status") == "PASS")


def hourly_grid(silver: DataFrame) -> DataFrame:
    """Pivot record types into measures per hour and respondent."""
    measures = [
        F.max(F.when(F.col("record_type") == code, F.col("value"))).alias(name)
        for code, name in RECORD_TYPES.items()
    ]
    hourly = (
        passing(silver)
        .groupBy("period", "period_date", "respondent", "respondent_name")
        .agg(
            *measures,
            F.countDistinct("record_type").alias("metric_count"),
            F.max("kafka_timestamp").alias("latest_kafka_timestamp"),
            F.coalesce(F.bool_or("replay"), F.lit(False)).alias("contains_replay"),
        )
    )
    return hourly.withColumns(hourly_measures())


def hourly_measures() -> dict[str, Column]:
    """Derived measures of the hourly grain."""
    demand, forecast = F.col("demand_mwh"), F.col("demand_forecast_mwh")
    generation = F.col("net_generation_mwh")
    error = demand - forecast
    return {
        "hour_of_day": F.hour("period"),
        "demand_forecast_error_mwh": error,
        "demand_forecast_abs_error_mwh": F.abs(error),
        "demand_forecast_error_pct": percent_of(error, forecast),
        "generation_demand_gap_mwh": generation - demand,
        "has_demand": demand.isNotNull(),
        "has_demand_forecast": forecast.isNotNull(),
        "has_generation": generation.isNotNull(),
        "has_interchange": F.col("total_interchange_mwh").isNotNull(),
    }


def location_key(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    """Both coordinates to four places, exact ties to even; NULL if one is not known."""

    def shown(name: str) -> Column:
        return F.regexp_replace(F.format_number(F.col(name), 4), ",", "")

    return F.concat(shown(latitude), F.lit(","), shown(longitude))


def precipitation_risk(probability: Column) -> Column:
    label = F.when(probability.isNull(), F.lit("unknown"))
    for name, below in PRECIPITATION_BANDS:
        label = label.when(probability < below, F.lit(name))
    return label.otherwise(F.lit("high"))


def hourly_weather(silver: DataFrame) -> DataFrame:
    """Forecast hours in both temperature scales with a rain band."""
    unit, degrees = F.col("temperature_unit"), F.col("temperature")
    return passing(silver).select(
        location_key().alias("location_key"),
        "latitude",
        "longitude",
        "period_start",
        "period_end",
        "forecast_date",
        F.hour("period_start").alias("forecast_hour"),
        "temperature",
        "temperature_unit",
        F.when(unit == "F", degrees)
        .when(unit == "C", degrees * 9 / 5 + 32)
        .alias("temperature_f"),
        F.when(unit == "C", degrees)
        .when(unit == "F", (degrees - 32) * 5 / 9)
        .alias("temperature_c"),
        "precipitation_probability",
        precipitation_risk(F.col("precipitation_probability")).alias("precipitation_risk"),
        "relative_humidity",
        "wind_speed",
        "wind_direction",
        "short_forecast",
        "event_id",
        "replay",
        "topic",
        "partition",
        "offset",
        "kafka_timestamp",
    )


def city_infrastructure(silver: DataFrame) -> DataFrame:
    """Charging infrastructure per city."""

    def ports(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    per_city = (
        passing(silver)
        .groupBy("city", "state", "country")
        .agg(
            F.countDistinct("station_id").alias("station_count"),
            F.sum(ports("ev_level1_evse_num")).alias("level1_ports"),
            F.sum(ports("ev_level2_evse_num")).alias("level2_ports"),
            F.sum(ports("ev_dc_fast_num")).alias("dc_fast_ports"),
            F.count_if(ports("ev_dc_fast_num") > 0).alias("dc_fast_station_count"),
            F.countDistinct("ev_network").alias("network_count"),
            F.max("updated_at").alias("latest_station_update"),
        )
    )
    total = F.col("level1_ports") + F.col("level2_ports") + F.col("dc_fast_ports")
    return per_city.withColumns(
        {
            "total_known_ports": total,
            "ports_per_station": F.try_divide(total.cast("double"), F.col("station_count")),
            "dc_fast_station_share_pct": percent_of(
                F.col("dc_fast_station_count").cast("double"), F.col("station_count")
            ),
        }
    )
