"""Declared schemas; nothing in the package infers a schema."""

from __future__ import annotations

# Sources, topics, envelope version.
EVENT_SOURCES = ("eia", "nws", "afdc", "platform")
EVENT_VERSION = "1.0"
TOPIC_SUFFIXES = {
    "eia": "eia.region-data.v1",
    "nws": "nws.forecast.v1",
    "afdc": "afdc.ev-stations.v1",
    "dead_letter": "dead-letter.v1",
}

# Per source the dataset and event type of its envelopes.
EVENT_KINDS = {
    "eia": ("eia_region_data", "eia.region_data.observed"),
    "nws": ("nws_hourly_forecast", "nws.forecast.hourly"),
    "afdc": ("afdc_ev_stations", "afdc.ev_station.snapshot"),
}


def topic(source: str, namespace: str) -> str:
    """Topic name of a source inside a deployment's namespace."""
    return f"{namespace}.{TOPIC_SUFFIXES[source]}"


RECORD = "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, key BINARY, value BINARY"

# The payload stays text: from_json copies a nested object into a STRING field
# unchanged, so one JSON pass yields both the scalars and the raw payload.
ENVELOPE = (
    "event_id STRING, event_version STRING, source STRING, dataset STRING, event_type STRING, "
    "partition_key STRING, emitted_at STRING, replay BOOLEAN, source_timestamp STRING, "
    "payload STRING"
)

ELECTRICITY_PAYLOAD = (
    "period STRING, record_type STRING, respondent STRING, respondent_name STRING, "
    "type_name STRING, value DOUBLE, value_units STRING"
)
WEATHER_PAYLOAD = (
    "latitude DOUBLE, longitude DOUBLE, period_start STRING, period_end STRING, "
    "temperature DOUBLE, temperature_unit STRING, precipitation_probability DOUBLE, "
    "relative_humidity DOUBLE, wind_speed STRING, wind_direction STRING, short_forecast STRING"
)
STATION_PAYLOAD = (
    "station_id BIGINT, station_name STRING, street_address STRING, city STRING, state STRING, "
    "zip_code STRING, country STRING, latitude DOUBLE, longitude DOUBLE, fuel_type_code STRING, "
    "access_code STRING, status_code STRING, ev_network STRING, "
    "ev_connector_types ARRAY<STRING>, ev_level1_evse_num INT, ev_level2_evse_num INT, "
    "ev_dc_fast_num INT, facility_type STRING, date_last_confirmed STRING, updated_at STRING"
)

LINEAGE_COLUMNS = (
    "event_id",
    "event_version",
    "event_type",
    "partition_key",
    "emitted_at",
    "replay",
    "source_timestamp",
    "topic",
    "partition",
    "offset",
    "kafka_timestamp",
    "kafka_key",
)

_LINEAGE = (
    "event_id STRING, event_version STRING, event_type STRING, partition_key STRING, "
    "emitted_at STRING, replay BOOLEAN, source_timestamp STRING, topic STRING, partition INT, "
    "offset BIGINT, kafka_timestamp TIMESTAMP, kafka_key STRING"
)
_QUALITY = "quality_error STRING, is_valid BOOLEAN, quality_status STRING"

BRONZE = (
    "topic STRING, partition INT, offset BIGINT, kafka_timestamp TIMESTAMP, kafka_key STRING, "
    "event_json STRING, event_id STRING, event_version STRING, dataset STRING, "
    "event_type STRING, partition_key STRING, emitted_at STRING, replay BOOLEAN, "
    "source_timestamp STRING, payload_json STRING, source STRING, kafka_date DATE, "
    "batch_id STRING"
)
BRONZE_QUARANTINE = (
    "topic STRING, partition INT, offset BIGINT, kafka_timestamp TIMESTAMP, kafka_key STRING, "
    "event_json STRING, event_id STRING, event_version STRING, source STRING, dataset STRING, "
    "event_type STRING, partition_key STRING, emitted_at STRING, replay BOOLEAN, "
    "source_timestamp STRING, payload_json STRING, validation_error STRING, is_valid BOOLEAN, "
    "kafka_date DATE, batch_id STRING"
)
SILVER_ELECTRICITY = (
    f"{_LINEAGE}, event_emitted_at TIMESTAMP, period_raw STRING, period TIMESTAMP, "
    "record_type STRING, respondent STRING, respondent_name STRING, type_name STRING, "
    f"value DOUBLE, value_units STRING, {_QUALITY}, period_date DATE"
)
SILVER_WEATHER = (
    f"{_LINEAGE}, event_emitted_at TIMESTAMP, latitude DOUBLE, longitude DOUBLE, "
    "period_start TIMESTAMP, period_end TIMESTAMP, temperature DOUBLE, temperature_unit STRING, "
    "precipitation_probability DOUBLE, relative_humidity DOUBLE, wind_speed STRING, "
    f"wind_direction STRING, short_forecast STRING, {_QUALITY}, forecast_date DATE"
)
SILVER_STATIONS = (
    f"{_LINEAGE}, event_emitted_at TIMESTAMP, station_id BIGINT, station_name STRING, "
    "street_address STRING, city STRING, zip_code STRING, country STRING, latitude DOUBLE, "
    "longitude DOUBLE, fuel_type_code STRING, access_code STRING, status_code STRING, "
    "ev_network STRING, ev_connector_types ARRAY<STRING>, ev_level1_evse_num INT, "
    "ev_level2_evse_num INT, ev_dc_fast_num INT, facility_type STRING, "
    f"date_last_confirmed DATE, updated_at TIMESTAMP, {_QUALITY}, state STRING"
)
SILVER_QUARANTINE = (
    "event_id STRING, event_type STRING, topic STRING, partition INT, offset BIGINT, "
    "kafka_timestamp TIMESTAMP, quality_error STRING, source STRING"
)
GOLD_HOURLY = (
    "period TIMESTAMP, respondent STRING, respondent_name STRING, demand_mwh DOUBLE, "
    "demand_forecast_mwh DOUBLE, net_generation_mwh DOUBLE, total_interchange_mwh DOUBLE, "
    "metric_count BIGINT, latest_kafka_timestamp TIMESTAMP, contains_replay BOOLEAN, "
    "hour_of_day INT, demand_forecast_error_mwh DOUBLE, demand_forecast_abs_error_mwh DOUBLE, "
    "demand_forecast_error_pct DOUBLE, generation_demand_gap_mwh DOUBLE, has_demand BOOLEAN, "
    "has_demand_forecast BOOLEAN, has_generation BOOLEAN, has_interchange BOOLEAN, "
    "period_date DATE"
)
GOLD_WEATHER = (
    "location_key STRING, latitude DOUBLE, longitude DOUBLE, period_start TIMESTAMP, "
    "period_end TIMESTAMP, forecast_hour INT, temperature DOUBLE, temperature_unit STRING, "
    "temperature_f DOUBLE, temperature_c DOUBLE, precipitation_probability DOUBLE, "
    "precipitation_risk STRING, relative_humidity DOUBLE, wind_speed STRING, "
    "wind_direction STRING, short_forecast STRING, event_id STRING, replay BOOLEAN, "
    "topic STRING, partition INT, offset BIGINT, kafka_timestamp TIMESTAMP, forecast_date DATE"
)
GOLD_CITY = (
    "city STRING, country STRING, station_count BIGINT, level1_ports BIGINT, "
    "level2_ports BIGINT, dc_fast_ports BIGINT, dc_fast_station_count BIGINT, "
    "network_count BIGINT, latest_station_update TIMESTAMP, total_known_ports BIGINT, "
    "ports_per_station DOUBLE, dc_fast_station_share_pct DOUBLE, state STRING"
)
RUN_LOG = (
    "run_id STRING, stage STRING, status STRING, started_at STRING, finished_at STRING, "
    "duration_seconds DOUBLE, exit_code BIGINT, records_processed BIGINT, "
    "throughput_records_per_second DOUBLE, command ARRAY<STRING>"
)
