"""Reference SQL of the queries that run jobs."""

from __future__ import annotations

from amperline.plans.oracles import (
    ENVELOPES,
    EVENTS,
    GOLD,
    LANDED,
    METRICS,
    ORACLES,
    PERFORMANCE,
    STATIONS,
    TOPIC,
    WEATHER,
    _with,
)
from amperline.sources.schemas import EVENT_KINDS

_SAFE = "TIMESTAMP '2024-01-31 10:00:00'"


def _two_windows() -> str:
    """Windows of two hours from the oldest period on, twice, with the watermark carried over."""
    parts = METRICS + """,
marks AS (
  SELECT respondent, CASE WHEN respondent <> 'R0' THEN min(period) END AS watermark
  FROM silver GROUP BY respondent),
seen AS (SELECT DISTINCT respondent, period FROM silver)"""
    before = "marks"
    for run in (1, 2):
        parts += f""",
plan{run} AS (
  SELECT respondent, watermark AS watermark_before,
    coalesce(watermark + INTERVAL 1 HOUR, TIMESTAMP '2024-01-05 00:00:00') AS window_start
  FROM {before}),
window{run} AS (
  SELECT *, least({_SAFE}, window_start + INTERVAL 1 HOUR) AS window_end FROM plan{run}
  WHERE window_start <= {_SAFE}),
report{run} AS (
  SELECT w.*, date_diff('hour', window_start, window_end) + 1 - (
    SELECT count(*) FROM seen s WHERE s.respondent = w.respondent
      AND s.period BETWEEN w.window_start AND w.window_end) AS missing_hours
  FROM window{run} w),
ended{run} AS (
  SELECT *, CASE WHEN missing_hours = 0 THEN window_end ELSE watermark_before END AS watermark
  FROM report{run}),
state{run} AS (
  SELECT b.respondent, CASE WHEN e.missing_hours = 0 THEN e.watermark ELSE b.watermark END AS watermark
  FROM {before} b LEFT JOIN ended{run} e USING (respondent))"""
        before = f"state{run}"
    moved = "(SELECT CAST(count(*) > 0 AS INTEGER) FROM ended{} WHERE missing_hours = 0)"
    return _with(
        parts,
        f"SELECT *, 1 + {moved.format(1)} AS version, 1 AS run FROM ended1 "
        f"UNION ALL SELECT *, 1 + {moved.format(1)} + {moved.format(2)}, 2 FROM ended2",
    )


def _judged(parts: str, records: str, key: str, first: str) -> str:
    """Reasons from rows with snapshot, no, off and reason; ``first`` are the checks of the metadata."""
    return (
        parts
        + f""",
records AS ({records}),
keyed AS (
  SELECT *, row_number() OVER (PARTITION BY snapshot, {key} ORDER BY off) AS nth FROM records),
judged AS (
  SELECT snapshot, any_value(no) AS no, count(*) AS record_count,
    count(*) FILTER (nth = 1) AS unique_key_count, min(off) FILTER (nth > 1) AS repeated_at,
    min(off) FILTER (reason IS NOT NULL) AS broken_at,
    arg_min(reason, off) FILTER (reason IS NOT NULL) AS broken
  FROM keyed GROUP BY snapshot),
reasons AS (
  SELECT snapshot, record_count, unique_key_count,
    CASE {first} WHEN repeated_at < coalesce(broken_at, repeated_at + 1) THEN 'duplicate_unique_key'
      ELSE broken END AS reason
  FROM judged)"""
    )


def _verdicts(judged: str, contract: str) -> str:
    return _with(
        judged,
        f"SELECT snapshot, '{contract}' AS contract, record_count, unique_key_count, reason, "
        "CASE WHEN reason IS NULL THEN 'PASSED' ELSE 'QUARANTINED' END AS verdict FROM reasons",
    )


def _messages(judged: str, source: str, columns: str, rows: str, contract: str) -> str:
    """Messages of the records whose snapshot has no reason."""
    dataset, event_type = EVENT_KINDS[source]
    return _with(
        judged,
        f"SELECT 'events.{contract}.v1' AS topic, '{source}' AS source, '{dataset}' AS dataset, "
        f"'{event_type}' AS event_type, false AS replay, {columns} "
        f"FROM {rows} JOIN reasons USING (snapshot) WHERE reasons.reason IS NULL",
    )


_METADATA = """WHEN no % 41 = 2 THEN 'missing_required_metadata'
      WHEN no % 43 = 3 THEN 'record_count_not_integer'
      WHEN no % 37 = 1 THEN 'record_count_mismatch'"""

JUDGED_WEATHER = _judged(
        WEATHER,
        """
  SELECT 'nation-' || s_nationkey || '-' || strftime(l_shipdate, '%Y%m%d') AS snapshot, off,
    date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) * 25 + s_nationkey AS no,
    latitude, longitude, period_start, l_quantity, short_forecast,
    CASE WHEN short_forecast = '' THEN 'empty_short_forecast'
      WHEN period_end <= period_start THEN 'invalid_forecast_interval' END AS reason
  FROM wx_typed""",
        "latitude, longitude, period_start",
        _METADATA,
)
JUDGED_STATIONS = _judged(
        STATIONS,
        """
  SELECT substr(r_name, 1, 2) || '-' || key % 300 AS snapshot, off,
    key % 300 + 300 * (SELECT r_regionkey FROM region r WHERE r.r_name = t.r_name) AS no, key, state,
    updated_at, ev_network,
    CASE WHEN key % 89 = 1 THEN 'invalid_fuel_type_code'
      WHEN key % 83 = 2 THEN 'invalid_access_code' WHEN key % 79 = 4 THEN 'invalid_status_code'
      WHEN key % 6 = 0 THEN 'invalid_ev_connector_types'
      WHEN state <> CASE WHEN (key % 300 + 300 * (SELECT r_regionkey FROM region r
        WHERE r.r_name = t.r_name)) % 31 = 4 THEN 'O1' ELSE substr(r_name, 1, 2) END
        THEN 'state_mismatch' END AS reason
  FROM ev_typed t""",
        "key",
        """WHEN no % 41 = 2 OR no % 23 = 5 AND no % 29 <> 3 THEN 'missing_required_metadata'
      WHEN no % 43 = 3 THEN 'record_count_not_integer'
      WHEN no % 37 = 1 THEN 'record_count_mismatch'
      WHEN no % 29 = 3 THEN 'total_results_too_small'
      WHEN no % 31 = 4 THEN 'invalid_query_state'""",
)

JOB_ORACLES: dict[str, str] = {
    "control_watermark": _two_windows(),
    "compacted_bronze": ORACLES["bronze_stream"],
    "incremental_gold_hourly": ORACLES["gold_hourly"],
    "incremental_stations": ORACLES["dedup_stations"],
    "landed_round_trip": _with(
        EVENTS,
        """SELECT 'run-' || event_id % 3 AS snapshot, 'eia_region_data' AS contract,
  count(*) AS record_count, count(DISTINCT (hour_ts, respondent, record_type)) AS unique_key_count,
  CASE WHEN count(DISTINCT (hour_ts, respondent, record_type)) < count(*)
    THEN 'duplicate_unique_key' END AS reason,
  CASE WHEN count(DISTINCT (hour_ts, respondent, record_type)) < count(*)
    THEN 'QUARANTINED' ELSE 'PASSED' END AS verdict,
  count(*) AS declared_records
FROM ev WHERE event_id % 3 < 2 GROUP BY event_id % 3""",
    ),
    "contract_verdicts_weather": _verdicts(JUDGED_WEATHER, "nws_hourly_forecast"),
    "contract_verdicts_stations": _verdicts(JUDGED_STATIONS, "afdc_ev_stations"),
    "published_envelopes": _messages(
        LANDED + ",\nreasons AS (SELECT snapshot, reason FROM verdicts)",
        "eia",
        "respondent AS kafka_key, 'pub-' || respondent || '-' || record_type AS event_id, "
        "respondent AS partition_key, strftime(hour_ts, '%Y-%m-%dT%H:%M:%S') AS source_timestamp, "
        "value, 'megawatthours' AS value_units",
        "land",
        "eia_region_data",
    ),
    "published_forecasts": _messages(
        JUDGED_WEATHER,
        "nws",
        "printf('%.4f,%.4f', latitude, longitude) AS kafka_key, "
        "'pub-' || printf('%.4f,%.4f', latitude, longitude) || '-' "
        "|| strftime(period_start, '%Y-%m-%dT%H:%M:%S') AS event_id, "
        "printf('%.4f,%.4f', latitude, longitude) AS partition_key, "
        "strftime(period_start, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS source_timestamp, "
        "l_quantity AS temperature, short_forecast",
        "records",
        "nws_hourly_forecast",
    ),
    "published_stations": _messages(
        JUDGED_STATIONS,
        "afdc",
        "upper(state) AS kafka_key, 'pub-' || key AS event_id, upper(state) AS partition_key, "
        "strftime(updated_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS source_timestamp, "
        "key AS station_id, ev_network",
        "records",
        "afdc_ev_stations",
    ),
    "quarantine_stream": _with(
        ENVELOPES,
        "SELECT topic, part AS \"partition\", event_id AS \"offset\", CAST(ts AS TIMESTAMP) AS kafka_timestamp, "
        "respondent AS kafka_key, validation_error, garbage FROM env WHERE validation_error IS NOT NULL",
    ),
    "stream_progress": "SELECT CAST(1 AS INTEGER) AS run, count(*) AS rows_processed FROM events "
    "UNION ALL SELECT 2, 0",
    "rewritten_layer": ORACLES["dedup_metrics"],
    "staged_views": _with(
        GOLD,
        "SELECT period_date, hour_of_day, count(*) AS rows, CAST(sum(metric_count) AS BIGINT) AS metrics, "
        "count(*) FILTER (contains_replay) AS replayed FROM gold GROUP BY ALL",
    ),
    "seeded_grid": _with(
        GOLD,
        "SELECT respondent, CASE WHEN respondent = 'R0' THEN 'national' WHEN respondent IN ('R1', 'R2') "
        "THEN 'region' ELSE 'balancing_authority' END AS entity_type, count(*) AS hours, "
        "count(demand_mwh) AS demand_hours FROM gold GROUP BY ALL",
    ),
    "exported_marts": _with(
        PERFORMANCE + "," + WEATHER + "," + STATIONS,
        "SELECT 'mart_grid_hourly' AS relation, count(*) AS rows FROM grid "
        "UNION ALL SELECT 'mart_balancing_authority_performance', count(*) FROM perf "
        "UNION ALL SELECT 'mart_ev_city_rankings', count(*) FROM city_mart "
        "UNION ALL SELECT 'mart_weather_forecast', count(*) FROM wx_gold",
    ),
    "landed_documents": _with(
        LANDED,
        "SELECT CAST(slot AS VARCHAR) AS slot, "
        "CAST(row_number() OVER (PARTITION BY slot ORDER BY event_id) - 1 AS INTEGER) "
        "AS position, respondent, record_type FROM land",
    ),
    "topic_ranges": f"""
WITH ranges AS (
  SELECT CAST(event_id % 3 AS INTEGER) AS "partition", min(event_id) AS start_offset,
    max(event_id) + 1 AS end_offset, count(*) AS records,
    max(event_id) + 1 - min(event_id) AS span
  FROM events GROUP BY 1)
SELECT '{TOPIC}' AS topic, *, (SELECT count(*) FROM events e
  WHERE CAST(e.event_id % 3 AS INTEGER) = r."partition" AND e.event_id >= r.start_offset
    AND e.event_id < r.start_offset + r.span // 2) AS first_half
FROM ranges r""",
    "outcome_stream": _with(
        ENVELOPES
        + """,
labelled AS (
  SELECT ts, CASE WHEN validation_error IS NULL THEN source ELSE 'unknown' END AS source,
    CASE WHEN validation_error IS NULL THEN 'processed' ELSE 'dead_lettered' END AS outcome FROM env
  UNION ALL
  SELECT ts, source, 'handler_failed' FROM env WHERE validation_error IS NULL AND event_id % 17 = 3)""",
        "SELECT CAST(date_trunc('minute', ts) AS TIMESTAMP) AS window_start, source, outcome, "
        "count(*) AS messages, round(count(*) / CAST(60 AS DOUBLE), 6) AS messages_per_second "
        "FROM labelled GROUP BY ALL",
    ),
}
