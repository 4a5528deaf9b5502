"""Analytical marts on top of Gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.operators.ranking import (
    dense_ranks_by_range,
    row_number_by_bucket,
    row_numbers_by_range,
)
from amperline.session import durable

# Aggregate respondents; every other respondent is an authority.
NATIONAL_RESPONDENTS = {"US48": "United States Lower 48"}
REGION_RESPONDENTS = {
    "CAL": "California",
    "CAR": "Carolinas",
    "CENT": "Central",
    "FLA": "Florida",
    "MIDA": "Mid-Atlantic",
    "MIDW": "Midwest",
    "NE": "New England",
    "NW": "Northwest",
    "NY": "New York",
    "SE": "Southeast",
    "SW": "Southwest",
    "TEN": "Tennessee",
    "TEX": "Texas",
}
ENTITY_TYPES = ("balancing_authority", "region", "national")

GRID_COLUMNS = (
    "grid_hour_key",
    "period",
    "period_date",
    "hour_of_day",
    "respondent",
    "respondent_name",
    "entity_type",
    "demand_mwh",
    "demand_forecast_mwh",
    "net_generation_mwh",
    "total_interchange_mwh",
    "demand_forecast_error_mwh",
    "demand_forecast_abs_error_mwh",
    "demand_forecast_error_pct",
    "generation_demand_gap_mwh",
    "metric_count",
    "has_demand",
    "has_demand_forecast",
    "has_generation",
    "has_interchange",
    "contains_replay",
    "latest_kafka_timestamp",
)
WEATHER_COLUMNS = (
    "weather_forecast_key",
    "location_key",
    "latitude",
    "longitude",
    "period_start",
    "period_end",
    "forecast_date",
    "forecast_hour",
    "temperature_f",
    "temperature_c",
    "precipitation_probability",
    "precipitation_risk",
    "relative_humidity",
    "wind_speed",
    "wind_direction",
    "short_forecast",
    "replay",
    "topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
    "forecast_sequence",
)


def joined_key(*parts: Column) -> Column:
    """Key text with ``|`` between parts; a NULL part counts as empty text."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.concat_ws("|", *texts)


def respondent_types(spark: SparkSession, seed_csv: str | None = None) -> DataFrame:
    """The aggregate-respondent dimension: built in, or read from a CSV seed."""
    schema = "respondent STRING, entity_type STRING, entity_name STRING"
    if seed_csv is not None:
        return spark.read.csv(seed_csv, header=True, schema=schema)
    rows = [(code, "national", name) for code, name in NATIONAL_RESPONDENTS.items()]
    rows += [(code, "region", name) for code, name in REGION_RESPONDENTS.items()]
    return spark.createDataFrame(rows, schema)


def staged_grid(gold: DataFrame) -> DataFrame:
    """Typed view of the hourly Gold table."""
    return gold.withColumns(
        {
            "period": F.col("period").cast("timestamp"),
            "period_date": F.col("period_date").cast("date"),
            "hour_of_day": F.col("hour_of_day").cast("int"),
            "metric_count": F.col("metric_count").cast("int"),
            "contains_replay": F.col("contains_replay").cast("boolean"),
            "latest_kafka_timestamp": F.col("latest_kafka_timestamp").cast("timestamp"),
        }
    )


def staged_weather(gold: DataFrame) -> DataFrame:
    """Typed view of the weather Gold table with bus columns renamed."""
    return gold.withColumns(
        {
            "kafka_partition": F.col("partition").cast("int"),
            "kafka_offset": F.col("offset").cast("long"),
            "forecast_hour": F.col("forecast_hour").cast("int"),
        }
    ).drop("partition", "offset")


def staged_cities(gold: DataFrame) -> DataFrame:
    """Typed view of the city Gold table."""
    counts = (
        "station_count",
        "level1_ports",
        "level2_ports",
        "dc_fast_ports",
        "total_known_ports",
        "dc_fast_station_count",
        "network_count",
    )
    return gold.withColumns(
        {
            **{name: F.col(name).cast("long") for name in counts},
            "ports_per_station": F.col("ports_per_station").cast("double"),
            "dc_fast_station_share_pct": F.col("dc_fast_station_share_pct").cast("double"),
        }
    )


def grid_hourly(gold: DataFrame, types: DataFrame) -> DataFrame:
    """Hourly mart; the dimension join is left to Spark's own size check."""
    kinds = types.select("respondent", F.col("entity_type").alias("known_type"))
    return (
        staged_grid(gold)
        .join(kinds, "respondent", "left")
        .withColumns(
            {
                "entity_type": F.coalesce("known_type", F.lit("balancing_authority")),
                "grid_hour_key": joined_key(F.col("respondent"), F.col("period")),
            }
        )
        .select(*GRID_COLUMNS)
    )


def authority_totals(grid: DataFrame) -> DataFrame:
    """Demand, accuracy and coverage per balancing authority, without ranks."""
    demand = F.col("demand_mwh").isNotNull()
    totals = (
        grid.where(F.col("entity_type") == "balancing_authority")
        .groupBy("respondent", "respondent_name")
        .agg(
            F.count("*").alias("observed_hours"),
            F.count_if("has_demand").alias("demand_hours"),
            F.count_if(demand & F.col("demand_forecast_mwh").isNotNull()).alias(
                "forecast_pair_hours"
            ),
            F.count_if(demand & F.col("net_generation_mwh").isNotNull()).alias(
                "generation_pair_hours"
            ),
            F.avg("demand_mwh").alias("average_demand_mwh"),
            F.max("demand_mwh").alias("peak_demand_mwh"),
            F.avg("demand_forecast_abs_error_mwh").alias("mean_abs_forecast_error_mwh"),
            F.avg(F.abs("demand_forecast_error_pct")).alias("mean_abs_forecast_error_pct"),
            F.avg("generation_demand_gap_mwh").alias("average_generation_demand_gap_mwh"),
            F.max("latest_kafka_timestamp").alias("latest_kafka_timestamp"),
            F.bool_or("contains_replay").alias("contains_replay"),
        )
    )

    def coverage(pairs: str) -> Column:
        return F.try_divide(F.col(pairs) * F.lit(100.0), F.col("demand_hours"))

    return totals.withColumns(
        {
            "forecast_coverage_pct": coverage("forecast_pair_hours"),
            "generation_coverage_pct": coverage("generation_pair_hours"),
        }
    )


def authority_performance(grid: DataFrame) -> DataFrame:
    """Authority totals with the two national dense ranks."""
    error, peak = "mean_abs_forecast_error_pct", "peak_demand_mwh"
    return dense_ranks_by_range(
        durable(authority_totals(grid)),
        {"forecast_accuracy_rank": (error, F.col(error)), "peak_demand_rank": (peak, -F.col(peak))},
    )


def city_rankings(gold: DataFrame) -> DataFrame:
    """City infrastructure with state and national positions."""
    # Range partitioning samples its input first, so the small table is stored.
    keyed = durable(
        staged_cities(gold).withColumn(
            "city_state_key", joined_key(F.col("city"), F.col("state"), F.col("country"))
        )
    )
    stations, ports = F.col("station_count"), F.col("total_known_ports")
    state, city, none = F.col("state"), F.col("city"), F.lit(None).cast("string")
    return row_numbers_by_range(
        keyed,
        ["city", "state", "country"],
        {
            "state_station_rank": [state, stations, ports, none, city],
            "national_station_rank": [none, stations, ports, state, city],
            "state_port_rank": [state, ports, stations, none, city],
        },
        ["desc", "desc", "asc_nulls_last", "asc_nulls_last"],
    )


def weather_forecast(gold: DataFrame) -> DataFrame:
    """Forecast mart; hours of a location are numbered day by day."""
    keyed = staged_weather(gold).withColumn(
        "weather_forecast_key", joined_key(F.col("location_key"), F.col("period_start"))
    )
    return row_number_by_bucket(
        keyed,
        "forecast_sequence",
        ["location_key"],
        "forecast_date",
        [F.col("period_start").asc_nulls_last()],
    ).select(*WEATHER_COLUMNS)
