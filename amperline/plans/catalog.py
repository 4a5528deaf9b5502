"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.functions.clock import instant
from amperline.operators import (
    contracts,
    coverage,
    freshness,
    gold,
    incidents,
    lineage,
    marts,
    publish,
    quality,
    runs,
    scoring,
    typed,
)
from amperline.operators.envelope import decode_records, parse_envelopes
from amperline.plans import bridges as b
from amperline.plans import serving
from amperline.session import durable, scratch_folder
from amperline.sources import bus, landed
from amperline.sources.tables import read_layer
from amperline.streaming.bronze import start_bronze
from amperline.streaming.outcomes import outcome_counts, outcome_rate

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
HISTORY_ROWS = 48


def comparable(frame: DataFrame) -> DataFrame:
    """Timestamps without a zone, so every reader shows the same UTC clock."""
    return frame.withColumns(
        {
            name: F.col(name).cast("timestamp_ntz")
            for name, kind in frame.dtypes
            if kind == "timestamp"
        }
    )


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return comparable(function(spark, sf))

    REGISTRY[function.__name__] = run
    return run


def rounded(frame: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return frame.withColumns({name: F.round(name, digits) for name in names})


def as_long(*names: str) -> list[Column]:
    return [F.col(name).cast("long").alias(name) for name in names]


# Bronze ------------------------------------------------------------------------

ENVELOPE_OUTPUT = (
    "topic",
    "partition",
    "offset",
    "kafka_timestamp",
    "kafka_key",
    "event_id",
    "event_version",
    "source",
    "dataset",
    "event_type",
    "partition_key",
    "emitted_at",
    "replay",
    "source_timestamp",
)


@query
def envelope_parse(spark, sf):
    return parse_envelopes(b.raw_topic(spark, sf)).select(
        *ENVELOPE_OUTPUT, "validation_error", "is_valid", "kafka_date"
    )


@query
def envelope_errors(spark, sf):
    parsed = parse_envelopes(b.raw_topic(spark, sf)).where(~F.col("is_valid"))
    return parsed.groupBy("validation_error").agg(F.count("*").alias("records"))


@query
def raw_payload(spark, sf):
    return b.electricity_bronze(spark, sf).select(
        "event_id",
        F.get_json_object("payload_json", "$.respondent").alias("respondent"),
        F.get_json_object("payload_json", "$.record_type").alias("record_type"),
        F.get_json_object("payload_json", "$.value").cast("double").alias("value"),
    )


@query
def bronze_stream(spark, sf):
    """The batch envelope parse, produced by a drained streaming query."""
    folder = scratch_folder(spark)
    b.topic_files(spark, sf, f"{folder}/topic", 1)
    stream = start_bronze(
        bus.folder_stream(spark, f"{folder}/topic"),
        f"{folder}/tables",
        f"{folder}/progress",
        namespace=b.NAMESPACE,
    )
    stream.awaitTermination()
    return read_layer(spark, f"{folder}/tables", "bronze_events").select(
        *ENVELOPE_OUTPUT, "kafka_date"
    )


@query
def outcome_totals(spark, sf):
    return outcome_counts(parse_envelopes(b.raw_topic(spark, sf)))


@query
def outcome_rate_1m(spark, sf):
    rates = outcome_rate(parse_envelopes(b.raw_topic(spark, sf)))
    return rounded(rates, "messages_per_second")


@query
def dead_letters(spark, sf):
    parsed = parse_envelopes(b.raw_topic(spark, sf)).where(~F.col("is_valid"))
    letters = publish.dead_letters(
        parsed,
        F.col("kafka_timestamp"),
        b.NAMESPACE,
        F.concat_ws("-", F.lit("dlq"), "partition", "offset"),
    )
    text = F.col("value").cast("string")
    return letters.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.get_json_object(text, "$.event_id").alias("event_id"),
        F.get_json_object(text, "$.source").alias("source"),
        F.get_json_object(text, "$.payload.original_topic").alias("original_topic"),
        F.get_json_object(text, "$.payload.original_partition").cast("int").alias(
            "original_partition"
        ),
        F.get_json_object(text, "$.payload.original_offset").cast("long").alias("original_offset"),
        F.get_json_object(text, "$.payload.failure_reason").alias("failure_reason"),
        F.get_json_object(text, "$.payload.raw_key").alias("raw_key"),
    )


# Silver ------------------------------------------------------------------------

METRIC_OUTPUT = (
    "event_id",
    "period",
    "period_date",
    "record_type",
    "respondent",
    "respondent_name",
    "value",
    "value_units",
    "quality_status",
)
FORECAST_OUTPUT = (
    "event_id",
    "latitude",
    "longitude",
    "period_start",
    "period_end",
    "forecast_date",
    "temperature",
    "temperature_unit",
    "precipitation_probability",
    "relative_humidity",
    "wind_speed",
    "short_forecast",
    "quality_status",
)
STATION_OUTPUT = (
    "event_id",
    "station_id",
    "station_name",
    "city",
    "state",
    "zip_code",
    "ev_network",
    "ev_level1_evse_num",
    "ev_level2_evse_num",
    "ev_dc_fast_num",
    "date_last_confirmed",
    "updated_at",
    "quality_status",
)


@query
def silver_metrics(spark, sf):
    return b.electricity_candidates(spark, sf).select(*METRIC_OUTPUT, "quality_error")


@query
def silver_forecast(spark, sf):
    return b.weather_candidates(spark, sf).select(*FORECAST_OUTPUT, "quality_error")


@query
def silver_stations(spark, sf):
    connectors = F.array_join("ev_connector_types", ",").alias("connectors")
    return b.station_candidates(spark, sf).select(*STATION_OUTPUT, connectors, "quality_error")


@query
def quarantine_union(spark, sf):
    return typed.quarantined(
        {
            "eia": b.electricity_candidates(spark, sf),
            "nws": b.weather_candidates(spark, sf),
            "afdc": b.station_candidates(spark, sf),
        }
    )


@query
def dedup_metrics(spark, sf):
    return b.electricity_silver(spark, sf).select(*METRIC_OUTPUT, "offset")


@query
def dedup_forecast(spark, sf):
    return b.weather_silver(spark, sf).select(*FORECAST_OUTPUT, "offset")


@query
def dedup_stations(spark, sf):
    return b.station_silver(spark, sf).select(*STATION_OUTPUT, "offset")


# Gold and marts ------------------------------------------------------------------


@query
def gold_hourly(spark, sf):
    return rounded(b.hourly_gold(spark, sf), "demand_forecast_error_pct")


@query
def gold_forecast(spark, sf):
    return rounded(b.weather_gold(spark, sf), "temperature_c", "temperature_f")


@query
def gold_city(spark, sf):
    return rounded(b.city_gold(spark, sf), "ports_per_station", "dc_fast_station_share_pct")


@query
def mart_grid_hourly(spark, sf):
    return rounded(b.grid_mart(spark, sf), "demand_forecast_error_pct")


PERFORMANCE_AVERAGES = (
    "average_demand_mwh",
    "mean_abs_forecast_error_mwh",
    "mean_abs_forecast_error_pct",
    "average_generation_demand_gap_mwh",
    "forecast_coverage_pct",
    "generation_coverage_pct",
)


def _performance(spark, sf):
    return marts.authority_performance(b.grid_mart(spark, sf))


@query
def authority_performance(spark, sf):
    return rounded(_performance(spark, sf), *PERFORMANCE_AVERAGES)


@query
def served_authorities(spark, sf):
    served = serving.authorities(_performance(spark, sf), 5)
    return rounded(served, *PERFORMANCE_AVERAGES)


@query
def city_rankings(spark, sf):
    return rounded(b.city_mart(spark, sf), "ports_per_station", "dc_fast_station_share_pct")


@query
def city_rankings_state(spark, sf):
    served = serving.cities(b.city_mart(spark, sf), "as", 25)
    return rounded(served, "ports_per_station", "dc_fast_station_share_pct")


@query
def forecast_mart(spark, sf):
    return rounded(b.weather_mart(spark, sf), "temperature_c", "temperature_f")


@query
def served_weather(spark, sf):
    served = serving.weather(b.weather_mart(spark, sf), 168)
    return rounded(served, "temperature_c", "temperature_f")


# Scoring ---------------------------------------------------------------------------


@query
def grid_anomalies(spark, sf):
    scored = serving.anomalies(b.ledger_mart(spark, sf), 100)
    return rounded(
        scored,
        "forecast_error_pct",
        "generation_gap_pct",
        "forecast_baseline_pct",
        "generation_baseline_pct",
    )


def _rounded_regions(frame):
    return rounded(
        frame,
        "net_generation_mwh",
        "total_interchange_mwh",
        "demand_baseline_mwh",
        "forecast_error_pct",
        "generation_gap_pct",
        digits=4,
    )


@query
def regional_signals(spark, sf):
    return _rounded_regions(serving.regions(b.ledger_mart(spark, sf), 25))


@query
def regional_history(spark, sf):
    history = serving.region_history(b.ledger_mart(spark, sf), " asia ", HISTORY_ROWS)
    return rounded(
        _rounded_regions(history), "demand_vs_baseline_pct", "demand_change_pct", digits=4
    )


@query
def history_summary(spark, sf):
    history = serving.region_history(b.ledger_mart(spark, sf), "EUROPE", HISTORY_ROWS)
    return rounded(scoring.history_summary(history), "average_demand_mwh", digits=4)


@query
def regional_timeline(spark, sf):
    return _rounded_regions(serving.timeline(b.ledger_mart(spark, sf), HISTORY_ROWS))


@query
def timeline_periods(spark, sf):
    return scoring.timeline_periods(serving.timeline(b.ledger_mart(spark, sf), HISTORY_ROWS))


@query
def timeline_frame(spark, sf):
    scored = serving.timeline(b.ledger_mart(spark, sf), HISTORY_ROWS)
    return _rounded_regions(scoring.timeline_frame(scored, instant("2000-06-01T00:00:00")))


@query
def severity_counts(spark, sf):
    return scoring.severity_counts(serving.anomalies(b.ledger_mart(spark, sf), 100))


@query
def peer_regions(spark, sf):
    signals = serving.regions(b.ledger_mart(spark, sf), 25)
    return scoring.peer_regions(signals, "EUROPE").select(
        "region", "pressure_score", "severity", "demand_vs_baseline_pct"
    )


# Operations ------------------------------------------------------------------------


def _signals(spark, sf):
    tables = {
        "mart_grid_hourly": b.grid_mart(spark, sf),
        "mart_weather_forecast": b.weather_gold(spark, sf),
        "mart_ev_city_rankings": b.city_gold(spark, sf),
    }
    return freshness.source_freshness(spark, tables, b.NOW)


@query
def source_freshness(spark, sf):
    return _signals(spark, sf)


@query
def freshness_counts(spark, sf):
    return freshness.freshness_counts(_signals(spark, sf))


def _runs(spark, sf):
    """The latest state of every run, stored because several parts read it."""
    return durable(runs.latest_runs(b.run_states(spark, sf)))


@query
def run_latest(spark, sf):
    latest = _runs(spark, sf)
    return latest.withColumn("command", F.array_join("command", " "))


@query
def run_recent(spark, sf):
    latest = serving.recent_runs(b.run_states(spark, sf), 200)
    return latest.withColumn("command", F.array_join("command", " "))


@query
def run_summary(spark, sf):
    return runs.run_summary(_runs(spark, sf))


@query
def stage_telemetry(spark, sf):
    return runs.stage_telemetry(_runs(spark, sf))


@query
def stage_sla(spark, sf):
    return runs.stage_sla(_runs(spark, sf), b.NOW)


def _incidents(spark, sf):
    return incidents.operational_incidents(_signals(spark, sf), b.component_states(spark, sf))


@query
def operational_incidents(spark, sf):
    return _incidents(spark, sf).drop("recommended_action")


@query
def highest_severity(spark, sf):
    return incidents.highest_severity(_incidents(spark, sf))


def _nodes(spark, sf):
    signals = durable(_signals(spark, sf))
    components = durable(b.component_states(spark, sf))
    return lineage.lineage_nodes(
        signals,
        components,
        incidents.operational_incidents(signals, components),
        _runs(spark, sf),
        b.NOW,
    )


@query
def lineage_nodes(spark, sf):
    return _nodes(spark, sf).select(
        "node_id",
        "layer",
        "state",
        "source",
        "run_stage",
        "latest_run_status",
        "recent_runs",
        "recent_failures",
        "operational_status",
        "latest_records_processed",
        F.col("detail").contains("Active incident").alias("has_incident"),
    )


@query
def lineage_edges(spark, sf):
    return lineage.lineage_edges(_nodes(spark, sf))


@query
def lineage_counts(spark, sf):
    return lineage.lineage_counts(_nodes(spark, sf))


@query
def worst_state(spark, sf):
    return lineage.worst_state(_nodes(spark, sf))


DATASETS = {"eia": "EIA Grid", "nws": "NWS Weather", "afdc": "AFDC EV"}
GRAINS = {
    "eia": ("period", "respondent", "respondent_name"),
    "nws": None,
    "afdc": ("city", "state", "country"),
}


def _layer_counts(spark, sf):
    """Counts of all layers from one pass over the records of each source, without storing one."""
    bronze = {
        "eia": b.electricity_bronze(spark, sf),
        "nws": b.weather_bronze(spark, sf),
        "afdc": b.station_bronze(spark, sf),
    }
    counted = []
    for spec in typed.TYPED_SOURCES:
        candidates = typed.typed_candidates(bronze[spec.source], spec)
        row = quality.source_counts(candidates, spec, GRAINS[spec.source])
        counted.append(
            row.unpivot([], row.columns, "layer", "rows").withColumn(
                "source", F.lit(spec.source)
            )
        )
    # the bus of electricity also carries messages that no Silver table takes
    other = bronze["eia"].where(~F.col("source").isin(*DATASETS)).agg(F.count("*").alias("rows"))
    for layer in ("BRONZE", "NOT_ROUTED"):
        counted.append(other.select(F.lit(layer).alias("layer"), "rows", F.lit("eia").alias("source")))
    dataset = b.lookup("source", DATASETS)
    parts = reduce(DataFrame.unionByName, counted).withColumn(
        "dataset", F.when(F.col("layer").isin("SILVER", "GOLD"), dataset).otherwise("All")
    )
    return parts.groupBy("layer", "dataset").agg(F.sum("rows").alias("rows"))


@query
def layer_counts(spark, sf):
    return _layer_counts(spark, sf)


@query
def data_quality(spark, sf):
    return quality.quality_snapshot(_layer_counts(spark, sf))


@query
def platform_status(spark, sf):
    grid = durable(b.grid_mart(spark, sf))
    return quality.platform_status(
        grid, marts.authority_totals(grid), b.city_gold(spark, sf), b.weather_gold(spark, sf)
    )


# The declared tests of the models, staging views and the seed.
RISKS = ("low", "moderate", "high", "unknown")
GRID_TESTS = (
    quality.ModelTests(
        "mart_grid_hourly",
        ("grid_hour_key", "period", "respondent", "entity_type", "contains_replay"),
        "grid_hour_key",
        (("entity_type", ("balancing_authority", "region", "national")),),
    ),
    quality.ModelTests(
        "stg_eia_balancing_authority_hourly",
        ("period", "respondent", "hour_of_day", "metric_count", "contains_replay"),
    ),
)
PERFORMANCE_TESTS = quality.ModelTests(
    "mart_balancing_authority_performance",
    ("respondent", "observed_hours", "contains_replay"),
    "respondent",
)
CITY_TESTS = (
    quality.ModelTests(
        "mart_ev_city_rankings", ("city_state_key", "city", "state", "station_count"), "city_state_key"
    ),
    quality.ModelTests("stg_afdc_city_infrastructure", ("city", "state", "country", "station_count")),
)
WEATHER_TESTS = (
    quality.ModelTests(
        "mart_weather_forecast",
        ("weather_forecast_key", "location_key", "period_start"),
        "weather_forecast_key",
        (("precipitation_risk", RISKS),),
    ),
    quality.ModelTests(
        "stg_nws_hourly_weather",
        ("location_key", "period_start", "forecast_date"),
        accepted=(("temperature_unit", ("F", "C")), ("precipitation_risk", RISKS)),
    ),
)
SEED_TESTS = quality.ModelTests(
    "eia_respondent_types",
    ("respondent", "entity_type", "entity_name"),
    "respondent",
    (("entity_type", ("region", "national")),),
)


@query
def dq_generic_tests(spark, sf):
    """The 40 declared tests, one pass over each of the frames that the models come from."""
    grid = durable(b.grid_mart(spark, sf))
    cities = b.city_gold(spark, sf).withColumn(
        "city_state_key", marts.joined_key(F.col("city"), F.col("state"), F.col("country"))
    )
    weather = b.weather_gold(spark, sf).withColumn(
        "weather_forecast_key", marts.joined_key(F.col("location_key"), F.col("period_start"))
    )
    parts = [
        quality.generic_tests(grid, *GRID_TESTS),
        quality.generic_tests(marts.authority_totals(grid), PERFORMANCE_TESTS),
        quality.generic_tests(cities, *CITY_TESTS),
        quality.generic_tests(weather, *WEATHER_TESTS),
        quality.generic_tests(marts.respondent_types(spark), SEED_TESTS),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def dq_singular_tests(spark, sf):
    grid = b.grid_mart(spark, sf)
    return quality.singular_tests(
        grid, marts.authority_totals(grid), b.city_gold(spark, sf), marts.respondent_types(spark)
    )


# Contracts, coverage, replay, publishing ------------------------------------------


@query
def contract_violations(spark, sf):
    _, records = b.landed_snapshots(spark, sf)
    judged = contracts.record_violations(
        records.withColumn("query_state", F.lit(None).cast("string")),
        contracts.ELECTRICITY_CONTRACT,
    )
    return judged.where(F.col("reason").isNotNull()).select(
        "snapshot", "position", "missing_fields", "unknown_fields", "reason"
    )


@query
def contract_verdicts(spark, sf):
    snapshots, records = b.landed_snapshots(spark, sf)
    return contracts.validate_snapshots(snapshots, records, contracts.ELECTRICITY_CONTRACT)


@query
def contract_gate(spark, sf):
    snapshots, records = b.landed_snapshots(spark, sf)
    accepted, rejected = contracts.gate(snapshots, records, contracts.ELECTRICITY_CONTRACT)
    sides = accepted.select(
        F.lit("accepted").alias("side"), F.lit(None).cast("string").alias("reason")
    ).unionByName(rejected.select(F.lit("quarantined").alias("side"), "reason"))
    return sides.groupBy("side", "reason").agg(F.count("*").alias("records"))


def _received(spark, sf):
    """Periods of every respondent in Silver, parsed once and stored: windows and coverage both read them."""
    return durable(b.electricity_silver(spark, sf).select("respondent", "period"))


def _watermarks(silver):
    """Oldest period per respondent as its control value; one never ran."""
    oldest = silver.groupBy("respondent").agg(F.min("period").alias("oldest"))
    return oldest.select(
        "respondent", F.when(F.col("respondent") != "R0", F.col("oldest")).alias("watermark")
    )


def _windows(silver):
    return coverage.next_window(
        _watermarks(silver), b.NOW, "2024-01-05T00:00:00", max_window_hours=240
    )


@query
def incremental_window(spark, sf):
    return _windows(b.electricity_silver(spark, sf)).select(
        "respondent", "watermark", "window_start", "window_end", *as_long("hour_count")
    )


@query
def coverage_gaps(spark, sf):
    silver = _received(spark, sf)
    return coverage.coverage_gaps(_windows(silver), silver, ["respondent"])


@query
def watermark_advance(spark, sf):
    silver = _received(spark, sf)
    return coverage.advance(_windows(silver), silver, ["respondent"])


def _history_records(spark, sf):
    """Records to replay, stored: a plan reads them for the messages and for the gaps."""
    names = ("period", "respondent", "respondent_name", "record_type", "type_name", "value", "value_units")
    return durable(b.electricity_silver(spark, sf).select(*names))


@query
def replay_gaps(spark, sf):
    return publish.replay_gaps(_history_records(spark, sf), 60.0)


@query
def replay_plan(spark, sf):
    records = _history_records(spark, sf)
    plan = publish.replay_plan(
        records,
        b.NOW,
        60.0,
        F.concat_ws("-", F.lit("replay"), "respondent", "record_type", publish.iso(F.col("period"))),
    )
    return plan.select(
        "event_id",
        "source",
        "dataset",
        "event_type",
        "partition_key",
        "replay",
        "source_timestamp",
        "period",
        "respondent",
        "record_type",
        "delay_seconds",
        F.col("payload.value").alias("value"),
    )


@query
def flatten_electricity(spark, sf):
    return landed.flatten_electricity(b.electricity_responses(spark, sf))


@query
def flatten_weather(spark, sf):
    return landed.flatten_weather(b.weather_responses(spark, sf), limit=24)


@query
def flatten_stations(spark, sf):
    flat = landed.flatten_stations(b.station_responses(spark, sf))
    return flat.withColumn("ev_connector_types", F.array_join("ev_connector_types", ","))


@query
def decoded_records(spark, sf):
    return decode_records(b.raw_topic(spark, sf)).select(
        "topic", "partition", "offset", "kafka_timestamp", "kafka_key"
    )


def _violations(records, contract):
    judged = contracts.record_violations(records, contract)
    return judged.where(F.col("reason").isNotNull()).select("snapshot", "position", "reason")


@query
def contract_violations_weather(spark, sf):
    return _violations(b.weather_records(spark, sf), contracts.WEATHER_CONTRACT)


@query
def contract_violations_stations(spark, sf):
    return _violations(b.station_records(spark, sf), contracts.STATION_CONTRACT)


@query
def normalised_weather(spark, sf):
    return contracts.normalised_weather(b.weather_records(spark, sf))


@query
def normalised_stations(spark, sf):
    normal = contracts.normalised_stations(b.station_records(spark, sf))
    return normal.withColumn("ev_connector_types", F.array_join("ev_connector_types", ","))


@query
def component_health(spark, sf):
    return incidents.component_health(b.component_states(spark, sf))
