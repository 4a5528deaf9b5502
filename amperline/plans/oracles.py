"""Independent SQL for the registered queries, run by another engine.

The statements start from the given tables, not from anything the package
computes. Shared parts are written once as named sub-queries.
"""

from __future__ import annotations

NOW = "TIMESTAMP '2024-01-31 12:00:00'"
TOPIC = "events.eia.region-data.v1"

# Electricity ---------------------------------------------------------------------

EVENTS = """
ev AS (
  SELECT event_id, ts, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_ts, user_id, event_type,
    value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
    'R' || (user_id % 8) AS respondent,
    CASE event_type WHEN 'purchase' THEN 'D' WHEN 'view' THEN 'DF' WHEN 'click' THEN 'NG'
      WHEN 'signup' THEN 'TI' WHEN 'error' THEN 'ERR' END AS record_type
  FROM events)"""

ENVELOPES = (
    EVENTS
    + f""",
env AS (
  SELECT *, event_id % 53 = 1 AS garbage,
    CASE WHEN event_id % 53 = 1 THEN 'missing_or_invalid_event_id'
      WHEN event_id % 59 = 2 THEN 'unsupported_event_version'
      WHEN event_id % 61 = 3 THEN 'missing_or_invalid_source'
      WHEN event_id % 67 = 4 THEN 'missing_or_invalid_partition_key'
      WHEN event_id % 71 = 5 THEN 'missing_or_invalid_replay'
      WHEN event_id % 73 = 6 THEN 'missing_or_invalid_payload' END AS validation_error,
    CASE WHEN event_id % 61 = 3 THEN 'unknown' WHEN event_id % 79 = 7 THEN 'platform'
      ELSE 'eia' END AS source,
    '{TOPIC}' AS topic, CAST(event_id % 3 AS INTEGER) AS part
  FROM ev)"""
)

_ENVELOPE_COLUMNS = """
  topic, part AS "partition", event_id AS "offset", ts AS kafka_timestamp,
  respondent AS kafka_key,
  CASE WHEN NOT garbage THEN 'evt-' || event_id END AS event_id,
  CASE WHEN NOT garbage THEN CASE WHEN event_id % 59 = 2 THEN '2.0' ELSE '1.0' END END
    AS event_version,
  CASE WHEN NOT garbage THEN source END AS source,
  CASE WHEN NOT garbage THEN 'eia_region_data' END AS dataset,
  CASE WHEN NOT garbage THEN 'eia.region_data.observed' END AS event_type,
  CASE WHEN NOT garbage THEN CASE WHEN event_id % 67 = 4 THEN '  ' ELSE respondent END END
    AS partition_key,
  CASE WHEN NOT garbage THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS emitted_at,
  CASE WHEN NOT garbage AND event_id % 71 <> 5 THEN k >= 50 END AS replay,
  CASE WHEN NOT garbage THEN strftime(hour_ts, '%Y-%m-%dT%H:%M:%S') END AS source_timestamp,
  CAST(ts AS DATE) AS kafka_date"""

METRICS = (
    ENVELOPES
    + """,
bronze AS (SELECT * FROM env WHERE validation_error IS NULL),
typed AS (
  SELECT *, CASE WHEN event_id % 107 <> 9 THEN hour_ts END AS period,
    CASE WHEN event_id % 101 <> 5 THEN value END AS reading,
    CASE WHEN event_id % 103 = 7 THEN ' ' ELSE 'megawatthours' END AS value_units
  FROM bronze WHERE source = 'eia'),
cand AS (
  SELECT *, CASE WHEN period IS NULL THEN 'invalid_period'
      WHEN reading IS NULL THEN 'invalid_value'
      WHEN trim(value_units) = '' THEN 'invalid_value_units' END AS quality_error
  FROM typed),
silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY period, respondent, record_type
      ORDER BY ts DESC, part DESC, event_id DESC) AS rn
    FROM cand WHERE quality_error IS NULL) WHERE rn = 1)"""
)

_METRIC_COLUMNS = """
  'evt-' || event_id AS event_id, period, CAST(period AS DATE) AS period_date, record_type,
  respondent, 'Respondent ' || respondent AS respondent_name, reading AS value, value_units"""

GOLD = (
    METRICS
    + """,
gold_base AS (
  SELECT period, CAST(period AS DATE) AS period_date, respondent,
    'Respondent ' || respondent AS respondent_name,
    max(CASE WHEN record_type = 'D' THEN reading END) AS demand_mwh,
    max(CASE WHEN record_type = 'DF' THEN reading END) AS demand_forecast_mwh,
    max(CASE WHEN record_type = 'NG' THEN reading END) AS net_generation_mwh,
    max(CASE WHEN record_type = 'TI' THEN reading END) AS total_interchange_mwh,
    count(DISTINCT record_type) AS metric_count, max(ts) AS latest_kafka_timestamp,
    bool_or(k >= 50) AS contains_replay
  FROM silver GROUP BY period, respondent),
gold AS (
  SELECT *, CAST(hour(period) AS INTEGER) AS hour_of_day,
    demand_mwh - demand_forecast_mwh AS demand_forecast_error_mwh,
    abs(demand_mwh - demand_forecast_mwh) AS demand_forecast_abs_error_mwh,
    CASE WHEN demand_forecast_mwh <> 0
      THEN (demand_mwh - demand_forecast_mwh) / demand_forecast_mwh * 100 END
      AS demand_forecast_error_pct,
    net_generation_mwh - demand_mwh AS generation_demand_gap_mwh,
    demand_mwh IS NOT NULL AS has_demand, demand_forecast_mwh IS NOT NULL AS has_demand_forecast,
    net_generation_mwh IS NOT NULL AS has_generation,
    total_interchange_mwh IS NOT NULL AS has_interchange
  FROM gold_base),
grid AS (
  SELECT respondent || '|' || CAST(period AS VARCHAR) AS grid_hour_key,
    'balancing_authority' AS entity_type, * REPLACE (CAST(metric_count AS INTEGER) AS metric_count)
  FROM gold)"""
)

PERFORMANCE = (
    GOLD
    + """,
perf AS (
  SELECT respondent, respondent_name, count(*) AS observed_hours,
    count(demand_mwh) AS demand_hours,
    count(demand_mwh) FILTER (demand_forecast_mwh IS NOT NULL) AS forecast_pair_hours,
    count(demand_mwh) FILTER (net_generation_mwh IS NOT NULL) AS generation_pair_hours,
    avg(demand_mwh) AS average_demand_mwh, max(demand_mwh) AS peak_demand_mwh,
    avg(demand_forecast_abs_error_mwh) AS mean_abs_forecast_error_mwh,
    avg(abs(demand_forecast_error_pct)) AS mean_abs_forecast_error_pct,
    avg(generation_demand_gap_mwh) AS average_generation_demand_gap_mwh,
    max(latest_kafka_timestamp) AS latest_kafka_timestamp,
    bool_or(contains_replay) AS contains_replay
  FROM grid WHERE entity_type = 'balancing_authority' GROUP BY respondent, respondent_name),
ranked_perf AS (
  SELECT respondent, respondent_name, observed_hours, demand_hours, forecast_pair_hours,
    generation_pair_hours, round(average_demand_mwh, 6) AS average_demand_mwh, peak_demand_mwh,
    round(mean_abs_forecast_error_mwh, 6) AS mean_abs_forecast_error_mwh,
    round(mean_abs_forecast_error_pct, 6) AS mean_abs_forecast_error_pct,
    round(average_generation_demand_gap_mwh, 6) AS average_generation_demand_gap_mwh,
    latest_kafka_timestamp, contains_replay,
    round(forecast_pair_hours * CAST(100 AS DOUBLE) / nullif(demand_hours, 0), 6)
      AS forecast_coverage_pct,
    round(generation_pair_hours * CAST(100 AS DOUBLE) / nullif(demand_hours, 0), 6)
      AS generation_coverage_pct,
    dense_rank() OVER (ORDER BY perf.mean_abs_forecast_error_pct ASC NULLS LAST)
      AS forecast_accuracy_rank,
    dense_rank() OVER (ORDER BY perf.peak_demand_mwh DESC NULLS LAST) AS peak_demand_rank
  FROM perf)"""
)

# Weather ---------------------------------------------------------------------------

WEATHER = """
wx_rows AS (
  SELECT l.*, s_nationkey,
    s_nationkey * CAST(3.5 AS DOUBLE) - CAST(40 AS DOUBLE) AS latitude,
    s_nationkey * CAST(7.25 AS DOUBLE) - CAST(120 AS DOUBLE) AS longitude,
    CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_linenumber % 2 * 12 AS INTEGER))
      AS period_start,
    (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey AS off,
    CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_orderkey % 1000) AS kafka_ts,
    CAST(l_linenumber % 3 AS INTEGER) AS part
  FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey),
wx_typed AS (
  SELECT *, 'wx-' || off AS event_id,
    CASE WHEN l_linenumber = 7 AND l_discount = CAST(0.1 AS DOUBLE) THEN period_start
      ELSE period_start + INTERVAL 1 HOUR END AS period_end,
    CASE WHEN l_linenumber = 6 AND l_quantity < 10 THEN 'K' WHEN l_returnflag = 'N' THEN 'C'
      ELSE 'F' END AS temperature_unit,
    CASE WHEN l_tax <> 0 THEN l_discount * CAST(1000 AS DOUBLE) END AS precipitation_probability,
    CASE WHEN l_linenumber = 5 AND l_quantity = 50 THEN CAST(150 AS DOUBLE)
      ELSE l_tax * CAST(1250 AS DOUBLE) END AS relative_humidity,
    CASE WHEN l_linenumber = 3 AND l_quantity = 1 THEN '' ELSE l_linestatus END AS short_forecast,
    l_linenumber || ' mph' AS wind_speed
  FROM wx_rows),
wx_cand AS (
  SELECT *, CASE WHEN latitude < -90 OR latitude > 90 THEN 'invalid_latitude'
      WHEN longitude < -180 OR longitude > 180 THEN 'invalid_longitude'
      WHEN period_end <= period_start THEN 'invalid_period_range'
      WHEN temperature_unit = 'K' THEN 'invalid_temperature_unit'
      WHEN precipitation_probability < 0 OR precipitation_probability > 100
        THEN 'invalid_precipitation_probability'
      WHEN relative_humidity < 0 OR relative_humidity > 100 THEN 'invalid_relative_humidity'
      WHEN short_forecast = '' THEN 'invalid_short_forecast' END AS quality_error
  FROM wx_typed),
wx_silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY latitude, longitude, period_start
      ORDER BY l_shipdate DESC, kafka_ts DESC, part DESC, off DESC) AS rn
    FROM wx_cand WHERE quality_error IS NULL) WHERE rn = 1),
wx_gold AS (
  SELECT printf('%.4f,%.4f', latitude, longitude) AS location_key, latitude, longitude,
    period_start, period_end, CAST(period_start AS DATE) AS forecast_date,
    CAST(hour(period_start) AS INTEGER) AS forecast_hour, l_quantity AS temperature,
    temperature_unit,
    round(CASE WHEN temperature_unit = 'F' THEN l_quantity ELSE l_quantity * 9 / 5 + 32 END, 6)
      AS temperature_f,
    round(CASE WHEN temperature_unit = 'C' THEN l_quantity ELSE (l_quantity - 32) * 5 / 9 END, 6)
      AS temperature_c,
    precipitation_probability,
    CASE WHEN precipitation_probability IS NULL THEN 'unknown'
      WHEN precipitation_probability < 20 THEN 'low'
      WHEN precipitation_probability < 50 THEN 'moderate' ELSE 'high' END AS precipitation_risk,
    relative_humidity, wind_speed, l_returnflag AS wind_direction, short_forecast, event_id,
    l_returnflag = 'R' AS replay, 'events.nws.forecast.hourly' AS topic, part AS "partition",
    off AS "offset", kafka_ts AS kafka_timestamp
  FROM wx_silver)"""

WEATHER_MART = (
    WEATHER
    + """,
wx_mart AS (
  SELECT location_key || '|' || CAST(period_start AS VARCHAR) AS weather_forecast_key,
    location_key, latitude, longitude, period_start, period_end, forecast_date, forecast_hour,
    temperature_f, temperature_c, precipitation_probability, precipitation_risk,
    relative_humidity, wind_speed, wind_direction, short_forecast, replay, topic,
    "partition" AS kafka_partition, "offset" AS kafka_offset, kafka_timestamp,
    row_number() OVER (PARTITION BY location_key ORDER BY period_start) AS forecast_sequence
  FROM wx_gold)"""
)

_FORECAST_COLUMNS = """
  event_id, latitude, longitude, period_start, period_end,
  CAST(period_start AS DATE) AS forecast_date, l_quantity AS temperature, temperature_unit,
  precipitation_probability, relative_humidity, wind_speed, short_forecast"""

# Stations ----------------------------------------------------------------------------

STATIONS = """
ev_rows AS (
  SELECT c.*, n_name, n_nationkey, r_name, version, c_custkey AS key,
    TIMESTAMP '2026-01-01 00:00:00' + to_minutes(c_custkey)
      + to_days(CAST(CASE WHEN c_custkey % 8 = 0 THEN version ELSE -version END AS INTEGER))
      AS updated_at,
    TIMESTAMP '2026-01-01 00:00:00' + to_hours(CAST(version AS INTEGER)) AS emitted,
    CAST(c_custkey % 3 AS INTEGER) AS part, c_custkey * 2 + version AS off
  FROM customer c JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN (VALUES (0), (1)) v(version) ON version = 0 OR c_custkey % 4 = 0),
ev_typed AS (
  SELECT *, 'ev-' || key || '-' || version AS event_id, n_name || '-' || (key % 10) AS city,
    CASE WHEN key % 97 = 3 THEN r_name ELSE substr(r_name, 1, 2) END AS state,
    lpad(CAST(key % 100000 AS VARCHAR), 5, '0') AS zip_code,
    n_nationkey * CAST(3.5 AS DOUBLE) - 40 AS latitude,
    n_nationkey * CAST(7.25 AS DOUBLE) - 120 AS longitude,
    CASE WHEN key % 13 <> 0 THEN c_mktsegment END AS ev_network,
    CAST(CASE WHEN key % 5 <> 0 THEN key % 3 END AS INTEGER) AS ev_level1_evse_num,
    CAST(CASE WHEN key % 11 <> 0 THEN key % 7 + version END AS INTEGER) AS ev_level2_evse_num,
    CAST(CASE WHEN key % 2 <> 0 THEN key % 4 END AS INTEGER) AS ev_dc_fast_num
  FROM ev_rows),
ev_cand AS (
  SELECT *, CASE WHEN key <= 0 THEN 'invalid_station_id'
      WHEN latitude < -90 OR latitude > 90 THEN 'invalid_latitude'
      WHEN longitude < -180 OR longitude > 180 THEN 'invalid_longitude'
      WHEN length(trim(state)) <> 2 THEN 'invalid_state'
      WHEN key % 89 = 1 THEN 'invalid_fuel_type' WHEN key % 83 = 2 THEN 'invalid_access_code'
      WHEN key % 79 = 4 THEN 'invalid_status_code' END AS quality_error
  FROM ev_typed),
ev_silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY key
      ORDER BY updated_at DESC, emitted DESC, part DESC, off DESC) AS rn
    FROM ev_cand WHERE quality_error IS NULL) WHERE rn = 1),
city_base AS (
  SELECT city, state, 'US' AS country, count(DISTINCT key) AS station_count,
    CAST(sum(coalesce(ev_level1_evse_num, 0)) AS BIGINT) AS level1_ports,
    CAST(sum(coalesce(ev_level2_evse_num, 0)) AS BIGINT) AS level2_ports,
    CAST(sum(coalesce(ev_dc_fast_num, 0)) AS BIGINT) AS dc_fast_ports,
    count(*) FILTER (ev_dc_fast_num > 0) AS dc_fast_station_count,
    count(DISTINCT ev_network) AS network_count, max(updated_at) AS latest_station_update
  FROM ev_silver GROUP BY city, state),
city_gold AS (
  SELECT *, level1_ports + level2_ports + dc_fast_ports AS total_known_ports,
    round((level1_ports + level2_ports + dc_fast_ports) / CAST(station_count AS DOUBLE), 6)
      AS ports_per_station,
    round(dc_fast_station_count / CAST(station_count AS DOUBLE) * 100, 6)
      AS dc_fast_station_share_pct
  FROM city_base),
city_mart AS (
  SELECT city || '|' || state || '|' || country AS city_state_key, *,
    row_number() OVER (PARTITION BY state
      ORDER BY station_count DESC, total_known_ports DESC, city) AS state_station_rank,
    row_number() OVER (
      ORDER BY station_count DESC, total_known_ports DESC, state, city) AS national_station_rank,
    row_number() OVER (PARTITION BY state
      ORDER BY total_known_ports DESC, station_count DESC, city) AS state_port_rank
  FROM city_gold)"""

_STATION_COLUMNS = """
  event_id, key AS station_id, c_name AS station_name, city, state, zip_code, ev_network,
  ev_level1_evse_num, ev_level2_evse_num, ev_dc_fast_num,
  CAST(updated_at AS DATE) AS date_last_confirmed, updated_at"""

_STATUS = "CASE WHEN quality_error IS NULL THEN 'PASS' ELSE 'FAIL' END AS quality_status"

# Ledger and scoring ---------------------------------------------------------------------

LEDGER = """
shipped AS (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS shipped
  FROM lineitem GROUP BY l_orderkey),
trades AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS period, n_name, r_name,
    CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderstatus, o_orderpriority, shipped
  FROM orders LEFT JOIN shipped ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey),
entity_trades AS (
  SELECT *, n_name AS respondent, 'balancing_authority' AS entity_type FROM trades
  UNION ALL SELECT *, r_name, 'region' FROM trades
  UNION ALL SELECT *, 'WORLD', 'national' FROM trades),
ledger_base AS (
  SELECT period, respondent, entity_type, CAST(sum(price) AS DOUBLE) AS demand_mwh,
    CAST(sum(price) FILTER (o_orderstatus IN ('F', 'O')) AS DOUBLE) * CAST(1.5 AS DOUBLE)
      AS demand_forecast_mwh,
    CAST(sum(shipped) AS DOUBLE) AS net_generation_mwh,
    bool_or(o_orderpriority = '1-URGENT') AS contains_replay
  FROM entity_trades GROUP BY ALL),
ledger AS (
  SELECT *, 'Area ' || respondent AS respondent_name,
    net_generation_mwh - demand_mwh AS total_interchange_mwh,
    CASE WHEN demand_forecast_mwh <> 0
      THEN (demand_mwh - demand_forecast_mwh) / demand_forecast_mwh * 100 END AS signed_error,
    abs(CASE WHEN demand_forecast_mwh <> 0
      THEN (demand_mwh - demand_forecast_mwh) / demand_forecast_mwh * 100 END) AS err,
    CASE WHEN demand_mwh > 0
      THEN abs((net_generation_mwh - demand_mwh) / demand_mwh) * 100 END AS gap
  FROM ledger_base WHERE demand_mwh > 0)"""


def _z(current: str, name: str, high: bool = False, clamp: bool = False) -> str:
    median, mean = (f"({current} - {name}_med)", f"({current} - {name}_avg)")
    if not high:
        median, mean = f"abs{median}", f"abs{mean}"
    guard = f"WHEN {current} <= {name}_med THEN 0" if high else ""
    score = f"""least(CAST(4 AS DOUBLE), CASE WHEN {current} IS NULL OR {name}_n < 24 THEN 0 {guard}
      WHEN {name}_mad > 0 THEN CAST(0.6745 AS DOUBLE) * {median} / {name}_mad
      WHEN {name}_sd > 0 THEN {mean} / {name}_sd ELSE 0 END)"""
    return f"greatest(CAST(0 AS DOUBLE), {score})" if clamp else score


_MEASURES = {"d": "demand_mwh", "f": "err", "g": "gap"}


def _history(entity: str, extra: str, pairs: str) -> str:
    """Every point of ``points`` with the statistics of its earlier points."""
    # The median is the mean of the two middle values, so that amounts in cents
    # are rounded the same way everywhere; median() interpolates instead.
    sorted_values = "list_sort(list(h.{c}) FILTER (h.{c} IS NOT NULL))"
    middle = (
        f"({sorted_values}[(count(h.{{c}}) + 1) // 2] "
        f"+ {sorted_values}[(count(h.{{c}}) + 2) // 2]) / 2"
    )
    first = ", ".join(
        f"count(h.{c}) AS {n}_n, {middle.format(c=c)} AS {n}_med, avg(h.{c}) AS {n}_avg, "
        f"stddev_samp(h.{c}) AS {n}_sd"
        for n, c in _MEASURES.items()
    )
    second = ", ".join(
        f"median(abs(h.{c} - s.{n}_med)) AS {n}_mad" for n, c in _MEASURES.items()
    )
    return f""",
base AS (SELECT * FROM ledger WHERE entity_type = '{entity}' {extra}),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY respondent ORDER BY period DESC) AS recency,
    lag(demand_mwh) OVER (PARTITION BY respondent ORDER BY period) AS previous
  FROM base),
points AS (SELECT * FROM ordered WHERE {pairs}),
stats AS (
  SELECT p.respondent, p.period, {first}
  FROM points p JOIN base h ON h.respondent = p.respondent AND h.period < p.period
  GROUP BY p.respondent, p.period),
mads AS (
  SELECT s.respondent, s.period, {second}
  FROM stats s JOIN base h ON h.respondent = s.respondent AND h.period < s.period
  GROUP BY s.respondent, s.period),
joined AS (
  SELECT * FROM points JOIN stats USING (respondent, period) JOIN mads USING (respondent, period)
  WHERE d_n >= 24)"""


_SEVERITY = """CASE WHEN round_even({s}, 1) >= 90 THEN 'CRITICAL' WHEN round_even({s}, 1) >= 75 THEN 'HIGH'
    WHEN round_even({s}, 1) >= 55 THEN 'ELEVATED' ELSE 'NORMAL' END"""

ANOMALIES = (
    LEDGER
    + _history(
        "balancing_authority",
        "AND demand_forecast_mwh > 0 AND signed_error IS NOT NULL",
        "recency = 1",
    )
    + f""",
raw_risk AS (
  SELECT *, {_z("err", "f")} AS fz, {_z("gap", "g")} AS gz FROM joined),
risk AS (
  SELECT *, least(CAST(100 AS DOUBLE), CAST(25 AS DOUBLE)
    * (CAST(0.7 AS DOUBLE) * fz + CAST(0.3 AS DOUBLE) * gz)) AS score FROM raw_risk),
anomalies AS (
  SELECT period, respondent, respondent_name, demand_mwh, demand_forecast_mwh,
    round(signed_error, 6) AS forecast_error_pct, round(gap, 6) AS generation_gap_pct,
    d_n AS history_points, round(f_med, 6) AS forecast_baseline_pct,
    round_even(fz, 2) AS forecast_deviation_score, round(g_med, 6) AS generation_baseline_pct,
    round_even(gz, 2) AS generation_deviation_score, round_even(score, 1) AS risk_score,
    {_SEVERITY.format(s="score")} AS severity
  FROM risk ORDER BY score DESC, period DESC, respondent LIMIT 100)"""
)


def _regions(pairs: str, clamp: bool, baseline: str) -> str:
    return (
        LEDGER
        + _history("region", "", pairs)
        + f""",
raw_pressure AS (
  SELECT *, {_z("demand_mwh", "d", True, clamp)} AS dz, {_z("err", "f", False, clamp)} AS fz,
    {_z("gap", "g", False, clamp)} AS gz FROM joined),
pressure AS (
  SELECT *, least(CAST(100 AS DOUBLE), CAST(25 AS DOUBLE) * (CAST(0.5 AS DOUBLE) * dz
    + CAST(0.3 AS DOUBLE) * fz + CAST(0.2 AS DOUBLE) * gz)) AS score FROM raw_pressure),
regions AS (
  SELECT period, respondent AS region, respondent_name AS region_name, demand_mwh,
    demand_forecast_mwh, round(net_generation_mwh, 4) AS net_generation_mwh,
    round(total_interchange_mwh, 4) AS total_interchange_mwh,
    {baseline} AS demand_baseline_mwh,
    round_even((demand_mwh - d_med) * CAST(100 AS DOUBLE) / d_med, 2) AS demand_vs_baseline_pct,
    round_even((demand_mwh - previous) * CAST(100 AS DOUBLE) / previous, 2) AS demand_change_pct,
    round(err, 4) AS forecast_error_pct, round(gap, 4) AS generation_gap_pct,
    d_n AS history_points, round_even(dz, 2) AS demand_deviation_score,
    round_even(fz, 2) AS forecast_deviation_score, round_even(gz, 2) AS generation_deviation_score,
    round_even(score, 1) AS pressure_score, {_SEVERITY.format(s="score")} AS severity,
    contains_replay
  FROM pressure)"""
    )


SIGNALS = _regions("recency = 1", False, "round(d_med, 4)")
TIMELINE = _regions("recency <= 48", True, "round_even(d_med, 2)")


def _region_history(region: str) -> str:
    return (
        LEDGER
        + f""",
base AS (SELECT * FROM ledger WHERE entity_type = 'region' AND respondent = '{region}'),
walked AS (
  SELECT *, lag(demand_mwh) OVER (ORDER BY period) AS previous,
    median(demand_mwh) OVER (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      AS med,
    row_number() OVER (ORDER BY period DESC) AS recency
  FROM base),
history AS (
  SELECT period, respondent AS region, respondent_name AS region_name, demand_mwh,
    demand_forecast_mwh, round(net_generation_mwh, 4) AS net_generation_mwh,
    round(total_interchange_mwh, 4) AS total_interchange_mwh,
    round(med, 4) AS demand_baseline_mwh,
    round((demand_mwh - med) * CAST(100 AS DOUBLE) / med, 4) AS demand_vs_baseline_pct,
    round((demand_mwh - previous) * CAST(100 AS DOUBLE) / previous, 4) AS demand_change_pct,
    round(err, 4) AS forecast_error_pct, round(gap, 4) AS generation_gap_pct, contains_replay
  FROM walked WHERE recency <= 48)"""
    )


# Operations ---------------------------------------------------------------------------

RUNS = (
    EVENTS
    + """,
pairs AS (
  SELECT s.event_id // 2 AS run_no, s.ts AS started, e.event_id AS end_id, e.ts AS finished,
    e.event_type AS end_type, e.k AS end_k,
    CASE s.event_id // 2 % 4 WHEN 0 THEN 'kafka_to_bronze' WHEN 1 THEN 'bronze_to_silver'
      WHEN 2 THEN 'build_gold' ELSE 'dbt_build' END AS stage,
    e.event_id IS NOT NULL AND e.event_id % 40 <> 39 AS ended
  FROM ev s LEFT JOIN ev e ON e.event_id = s.event_id + 1 WHERE s.event_id % 2 = 0),
runs AS (
  SELECT 'run-' || run_no AS run_id, stage,
    CASE WHEN NOT ended THEN 'STARTED' WHEN end_type = 'error' THEN 'FAILED'
      ELSE 'SUCCEEDED' END AS status,
    started AS started_at, CASE WHEN ended THEN finished END AS finished_at,
    CASE WHEN ended THEN (epoch_us(finished) // 1000 - epoch_us(started) // 1000) / CAST(1000 AS DOUBLE) END
      AS duration_seconds,
    CAST(CASE WHEN ended THEN CASE WHEN end_type = 'error' THEN 1 ELSE 0 END END AS BIGINT)
      AS exit_code,
    CAST(CASE WHEN ended AND end_k >= 10 THEN end_k * 10 END AS BIGINT) AS records_processed,
    'run ' || stage AS command
  FROM pairs),
run_rows AS (
  SELECT *, CASE WHEN duration_seconds > 0
    THEN round_even(records_processed / duration_seconds, 3) END AS throughput_records_per_second
  FROM runs),
telemetry AS (
  SELECT r.stage, arg_max(run_id, started_at) AS latest_run_id,
    arg_max(status, started_at) AS latest_status, max(started_at) AS latest_started_at,
    max(finished_at) FILTER (newest) AS latest_finished_at,
    max(duration_seconds) FILTER (newest) AS latest_duration_seconds,
    max(CASE WHEN status = 'SUCCEEDED' THEN coalesce(finished_at, started_at) END)
      AS last_success_at,
    count(*) AS recent_runs, count(*) FILTER (status = 'FAILED') AS recent_failures,
    count(*) FILTER (status = 'SUCCEEDED') AS recent_successes,
    max(records_processed) FILTER (newest) AS latest_records_processed,
    max(throughput_records_per_second) FILTER (newest) AS latest_throughput_records_per_second,
    median(duration_seconds) FILTER (status = 'SUCCEEDED' AND duration_seconds > 0) AS med,
    count(*) FILTER (status = 'SUCCEEDED' AND duration_seconds > 0) AS timed
  FROM (SELECT *, started_at = max(started_at) OVER (PARTITION BY stage) AS newest FROM run_rows) r
  GROUP BY r.stage)"""
)

SLA = (
    RUNS
    + f""",
targets(stage, display_name, fallback) AS (
  VALUES ('kafka_to_bronze', 'Kafka → Bronze', CAST(300 AS DOUBLE)),
    ('bronze_to_silver', 'Bronze → Silver', CAST(600 AS DOUBLE)),
    ('build_gold', 'Gold Analytics Build', CAST(600 AS DOUBLE)),
    ('dbt_build', 'dbt Analytics Build', CAST(600 AS DOUBLE))),
timed_sla AS (
  SELECT t.*, m.*, CAST(24 AS DOUBLE) AS max_success_age_hours,
    CASE WHEN timed >= 3 THEN round_even(greatest(60, least(3600, med * 4)), 3) ELSE fallback END
      AS expected_max_runtime_seconds,
    CASE WHEN timed >= 3 THEN 'observed_median_x4' ELSE 'configured_fallback' END
      AS runtime_threshold_basis,
    round_even(greatest(0, (epoch_us({NOW}) - epoch_us(last_success_at))
      / CAST(3600000000 AS DOUBLE)), 3) AS success_age_hours,
    CASE WHEN latest_status = 'STARTED'
      THEN round_even(greatest(0, (epoch_us({NOW}) - epoch_us(latest_started_at))
        / CAST(1000000 AS DOUBLE)), 3)
      ELSE latest_duration_seconds END AS current_runtime_seconds
  FROM targets t LEFT JOIN (SELECT stage AS s, * EXCLUDE (stage) FROM telemetry) m
    ON m.s = t.stage),
sla AS (
  SELECT stage, display_name, CASE WHEN latest_status IS NULL THEN 'NO_RUN_DATA'
      WHEN latest_status = 'STARTED' THEN CASE
        WHEN current_runtime_seconds > expected_max_runtime_seconds THEN 'STALLED'
        ELSE 'RUNNING' END
      WHEN latest_status = 'FAILED' THEN 'FAILED'
      WHEN success_age_hours > max_success_age_hours THEN 'OVERDUE'
      ELSE 'SUCCEEDED' END AS status,
    latest_status AS latest_run_status, latest_run_id, current_runtime_seconds,
    expected_max_runtime_seconds, runtime_threshold_basis, last_success_at, success_age_hours,
    max_success_age_hours, recent_runs, recent_failures, latest_records_processed
  FROM timed_sla)"""
)

FRESHNESS = (
    GOLD
    + ","
    + WEATHER
    + ","
    + STATIONS
    + f""",
newest AS (
  SELECT 'eia' AS source, 'EIA Grid' AS display_name,
    'Electricity regional operations' AS dataset, max(period) AS latest_timestamp,
    'Latest analytical period' AS timestamp_basis, CAST(6 AS DOUBLE) AS fresh_within_hours,
    CAST(24 AS DOUBLE) AS stale_after_hours FROM gold
  UNION ALL SELECT 'nws', 'NWS Weather', 'Hourly weather forecast', max(kafka_timestamp),
    'Kafka event timestamp', 6, 24 FROM wx_gold
  UNION ALL SELECT 'afdc', 'AFDC EV', 'EV charging infrastructure', max(latest_station_update),
    'Latest station update', 48, 168 FROM city_gold),
aged AS (
  SELECT *, greatest(0, (epoch_us({NOW}) - epoch_us(latest_timestamp))
    / CAST(3600000000 AS DOUBLE)) AS age FROM newest),
signals AS (
  SELECT source, display_name, dataset, latest_timestamp, timestamp_basis, fresh_within_hours,
    stale_after_hours, CASE WHEN age <= fresh_within_hours THEN 'FRESH'
      WHEN age <= stale_after_hours THEN 'DELAYED' ELSE 'STALE' END AS state,
    round_even(age, 2) AS age_hours FROM aged)"""
)

COMPONENTS = """
parts AS (
  SELECT CASE user_id % 4 WHEN 0 THEN 'warehouse' WHEN 1 THEN 'kafka' WHEN 2 THEN 'prometheus'
      ELSE 'kafka_consumer' END AS name,
    count(*) AS n, count(*) FILTER (event_type = 'error') AS bad, max(value) AS latency_ms
  FROM events GROUP BY 1),
components AS (
  SELECT name, latency_ms, bad || ' of ' || n || ' events are errors.' AS detail,
    CASE WHEN bad / CAST(n AS DOUBLE) > CAST(0.205 AS DOUBLE) THEN 'unhealthy'
      WHEN bad / CAST(n AS DOUBLE) > CAST(0.198 AS DOUBLE) THEN 'degraded'
      ELSE 'healthy' END AS status
  FROM parts)"""

INCIDENTS = (
    FRESHNESS
    + ","
    + COMPONENTS
    + """,
incidents AS (
  SELECT 'source:' || source || ':' || lower(state) AS incident_id,
    CASE state WHEN 'STALE' THEN 'HIGH' ELSE 'ELEVATED' END AS severity,
    'DATA_FRESHNESS' AS category, display_name || ' source is ' || lower(state) AS title, source,
    state AS current_state,
    printf('Latest signal is %.1fh old. %s is %.0fh. Basis: %s.', age_hours,
      CASE state WHEN 'STALE' THEN 'Stale threshold' ELSE 'Freshness target' END,
      CASE state WHEN 'STALE' THEN stale_after_hours ELSE fresh_within_hours END,
      timestamp_basis) AS evidence
  FROM signals WHERE state <> 'FRESH'
  UNION ALL
  SELECT 'component:' || name || ':' || status,
    CASE status WHEN 'unhealthy' THEN 'CRITICAL' ELSE 'HIGH' END, 'PLATFORM_RUNTIME',
    CASE name WHEN 'kafka_consumer' THEN 'Kafka Consumer'
      ELSE upper(name[1]) || name[2:] END || ' is ' || status,
    name, upper(status), printf('%s Observed latency: %.1f ms.', detail, latency_ms)
  FROM components WHERE status <> 'healthy')"""
)

LINEAGE = (
    INCIDENTS
    + ","
    + SLA.replace(EVENTS, "", 1).lstrip(",")
    + """,
node_list(node_id, layer, kind, ref) AS (
  VALUES ('source-eia', 'SOURCE', 'source', 'eia'), ('source-nws', 'SOURCE', 'source', 'nws'),
    ('source-afdc', 'SOURCE', 'source', 'afdc'), ('kafka', 'STREAMING', 'component', 'kafka'),
    ('spark-bronze', 'LAKEHOUSE', 'stage', 'kafka_to_bronze'),
    ('spark-silver', 'LAKEHOUSE', 'stage', 'bronze_to_silver'),
    ('spark-gold', 'ANALYTICS', 'stage', 'build_gold'), ('dbt', 'MODELING', 'stage', 'dbt_build'),
    ('duckdb', 'WAREHOUSE', 'component', 'warehouse'),
    ('fastapi', 'SERVING', 'dependent', 'warehouse'),
    ('nextjs', 'EXPERIENCE', 'dependent', 'warehouse')),
nodes AS (
  SELECT node_id, layer,
    CASE kind WHEN 'source' THEN CASE g.state WHEN 'FRESH' THEN 'HEALTHY'
        WHEN 'DELAYED' THEN 'DEGRADED' WHEN 'STALE' THEN 'UNHEALTHY' ELSE 'UNKNOWN' END
      WHEN 'stage' THEN CASE WHEN a.status IN ('FAILED', 'STALLED') THEN 'UNHEALTHY'
        WHEN a.status = 'OVERDUE' THEN 'DEGRADED'
        WHEN a.status IN ('RUNNING', 'SUCCEEDED') THEN 'HEALTHY' ELSE 'UNKNOWN' END
      ELSE upper(coalesce(c.status, 'unknown')) END AS state,
    CASE WHEN kind IN ('source', 'component') THEN ref END AS source, a.stage AS run_stage,
    a.latest_run_status, coalesce(a.recent_runs, 0) AS recent_runs,
    coalesce(a.recent_failures, 0) AS recent_failures, a.status AS operational_status,
    a.latest_records_processed,
    kind IN ('source', 'component') AND ref IN (SELECT source FROM incidents) AS has_incident
  FROM node_list LEFT JOIN signals g ON kind = 'source' AND g.source = ref
    LEFT JOIN sla a ON kind = 'stage' AND a.stage = ref
    LEFT JOIN components c ON kind IN ('component', 'dependent') AND c.name = ref)"""
)

LAYERS = (
    GOLD
    + ","
    + WEATHER
    + ","
    + STATIONS
    + """,
quarantine AS (
  SELECT quality_error FROM cand WHERE quality_error IS NOT NULL
  UNION ALL SELECT quality_error FROM wx_cand WHERE quality_error IS NOT NULL
  UNION ALL SELECT quality_error FROM ev_cand WHERE quality_error IS NOT NULL),
layers(layer, dataset, rows) AS (
  SELECT 'BRONZE', 'All', (SELECT count(*) FROM bronze) + (SELECT count(*) FROM wx_cand)
    + (SELECT count(*) FROM ev_cand)
  UNION ALL SELECT 'SILVER', 'EIA Grid', count(*) FROM silver
  UNION ALL SELECT 'SILVER', 'NWS Weather', count(*) FROM wx_silver
  UNION ALL SELECT 'SILVER', 'AFDC EV', count(*) FROM ev_silver
  UNION ALL SELECT 'GOLD', 'EIA Grid', count(*) FROM gold
  UNION ALL SELECT 'GOLD', 'NWS Weather', count(*) FROM wx_gold
  UNION ALL SELECT 'GOLD', 'AFDC EV', count(*) FROM city_gold
  UNION ALL SELECT 'QUARANTINE', 'All', count(*) FROM quarantine
  UNION ALL SELECT 'NOT_ROUTED', 'All', count(*) FROM bronze WHERE source = 'platform')"""
)

# Contracts, coverage, replay -----------------------------------------------------------

LANDED = (
    EVENTS
    + """,
land AS (
  SELECT *, user_id % 50 AS slot,
    'snap-' || (user_id % 50) || '-' || strftime(ts, '%Y%m%d') AS snapshot,
    date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 50 + user_id % 50 AS snapshot_no
  FROM ev),
judged AS (
  SELECT *, concat_ws(', ', CASE WHEN event_id % 223 = 5 THEN 'value-units' END) AS missing_fields,
    CASE WHEN event_id % 211 = 3 THEN 'extra' ELSE '' END AS unknown_fields,
    CASE WHEN event_id % 223 = 5 THEN 'missing_fields' WHEN event_id % 211 = 3
      THEN 'unknown_fields' WHEN event_id % 227 = 7 THEN 'invalid_value' END AS reason
  FROM land),
keyed AS (
  SELECT snapshot, event_id, row_number() OVER (
    PARTITION BY snapshot, hour_ts, respondent, record_type ORDER BY event_id) AS nth
  FROM land),
per_key AS (
  SELECT snapshot, count(*) FILTER (nth = 1) AS unique_key_count,
    min(event_id) FILTER (nth > 1) AS repeated_at
  FROM keyed GROUP BY snapshot),
per_snapshot AS (
  SELECT snapshot, any_value(snapshot_no) AS no, count(*) AS record_count,
    arg_min(reason, event_id) FILTER (reason IS NOT NULL) AS broken,
    min(event_id) FILTER (reason IS NOT NULL) AS broken_at
  FROM judged GROUP BY snapshot),
verdicts AS (
  SELECT snapshot, 'eia_region_data' AS contract, record_count, unique_key_count,
    CASE WHEN no % 41 = 2 THEN 'missing_required_metadata'
      WHEN no % 37 = 1 THEN 'record_count_mismatch' WHEN repeated_at < broken_at
        OR broken_at IS NULL AND repeated_at IS NOT NULL THEN 'duplicate_unique_key'
      ELSE broken END AS reason
  FROM per_snapshot JOIN per_key USING (snapshot))"""
)

WINDOWS = (
    METRICS
    + f""",
oldest AS (SELECT respondent, min(period) AS oldest FROM silver GROUP BY respondent),
marks AS (
  SELECT respondent, CASE WHEN respondent <> 'R0' THEN oldest END AS watermark FROM oldest),
starts AS (
  SELECT *, coalesce(watermark + INTERVAL 1 HOUR, TIMESTAMP '2024-01-05 00:00:00')
    AS window_start FROM marks),
windows AS (
  SELECT respondent, watermark, window_start,
    least(TIMESTAMP '2024-01-31 10:00:00', window_start + INTERVAL 239 HOUR) AS window_end
  FROM starts WHERE window_start <= {NOW} - INTERVAL 2 HOUR),
expected AS (
  SELECT respondent, watermark, window_end,
    unnest(generate_series(window_start, window_end, INTERVAL 1 HOUR)) AS period FROM windows),
gaps AS (
  SELECT e.respondent, e.period FROM expected e
  WHERE NOT EXISTS (SELECT 1 FROM silver s
    WHERE s.respondent = e.respondent AND s.period = e.period))"""
)

REPLAY = (
    METRICS
    + """,
hours AS (
  SELECT period, lag(period) OVER (ORDER BY period) AS previous_period
  FROM (SELECT DISTINCT period FROM silver)),
delays AS (
  SELECT *, (epoch_us(period) - epoch_us(previous_period)) / CAST(1000000 AS DOUBLE) / 60
    AS delay_seconds FROM hours)"""
)


def _with(parts: str, body: str) -> str:
    return f"WITH {parts.strip()}\n{body}"


ORACLES: dict[str, str] = {
    "envelope_parse": _with(
        ENVELOPES,
        f"SELECT {_ENVELOPE_COLUMNS}, validation_error, validation_error IS NULL AS is_valid "
        "FROM env",
    ),
    "envelope_errors": _with(
        ENVELOPES,
        "SELECT validation_error, count(*) AS records FROM env "
        "WHERE validation_error IS NOT NULL GROUP BY 1",
    ),
    "raw_payload": _with(
        METRICS,
        "SELECT 'evt-' || event_id AS event_id, respondent, record_type, "
        "CASE WHEN event_id % 101 <> 5 THEN value END AS value FROM bronze",
    ),
    "bronze_stream": _with(
        ENVELOPES, f"SELECT {_ENVELOPE_COLUMNS} FROM env WHERE validation_error IS NULL"
    ),
    "outcome_totals": _with(
        ENVELOPES,
        "SELECT CASE WHEN validation_error IS NULL THEN source ELSE 'unknown' END AS source, "
        "CASE WHEN validation_error IS NULL THEN 'processed' ELSE 'dead_lettered' END AS outcome, "
        "count(*) AS messages FROM env GROUP BY ALL",
    ),
    "outcome_rate_1m": _with(
        ENVELOPES,
        "SELECT CAST(date_trunc('minute', ts) AS TIMESTAMP) AS window_start, "
        "CASE WHEN validation_error IS NULL THEN source ELSE 'unknown' END AS source, "
        "CASE WHEN validation_error IS NULL THEN 'processed' ELSE 'dead_lettered' END AS outcome, "
        "count(*) AS messages, round(count(*) / CAST(60 AS DOUBLE), 6) AS messages_per_second "
        "FROM env GROUP BY ALL",
    ),
    "dead_letters": _with(
        ENVELOPES,
        "SELECT 'events.dead-letter.v1' AS topic, topic AS key, "
        "'dlq-' || part || '-' || event_id AS event_id, 'platform' AS source, "
        "topic AS original_topic, part AS original_partition, event_id AS original_offset, "
        "validation_error AS failure_reason, respondent AS raw_key "
        "FROM env WHERE validation_error IS NOT NULL",
    ),
    "decoded_records": _with(
        ENVELOPES,
        'SELECT topic, part AS "partition", event_id AS "offset", ts AS kafka_timestamp, '
        "respondent AS kafka_key FROM env",
    ),
    "silver_metrics": _with(
        METRICS, f"SELECT {_METRIC_COLUMNS}, {_STATUS}, quality_error FROM cand"
    ),
    "silver_forecast": _with(
        WEATHER, f"SELECT {_FORECAST_COLUMNS}, {_STATUS}, quality_error FROM wx_cand"
    ),
    "silver_stations": _with(
        STATIONS,
        f"SELECT {_STATION_COLUMNS}, {_STATUS}, "
        "CASE WHEN key % 6 <> 0 THEN 'J1772,TESLA' END AS connectors, quality_error FROM ev_cand",
    ),
    "quarantine_union": _with(
        METRICS + "," + WEATHER + "," + STATIONS,
        "SELECT 'eia' AS source, 'evt-' || event_id AS event_id, "
        "'eia.region_data.observed' AS event_type, topic, part AS \"partition\", "
        'event_id AS "offset", ts AS kafka_timestamp, quality_error '
        "FROM cand WHERE quality_error IS NOT NULL "
        "UNION ALL SELECT 'nws', event_id, 'nws.forecast.hourly', 'events.nws.forecast.hourly', "
        "part, off, kafka_ts, quality_error FROM wx_cand WHERE quality_error IS NOT NULL "
        "UNION ALL SELECT 'afdc', event_id, 'afdc.ev_station.snapshot', "
        "'events.afdc.ev_station.snapshot', part, off, emitted, quality_error "
        "FROM ev_cand WHERE quality_error IS NOT NULL",
    ),
    "dedup_metrics": _with(
        METRICS, f'SELECT {_METRIC_COLUMNS}, {_STATUS}, event_id AS "offset" FROM silver'
    ),
    "dedup_forecast": _with(
        WEATHER, f'SELECT {_FORECAST_COLUMNS}, {_STATUS}, off AS "offset" FROM wx_silver'
    ),
    "dedup_stations": _with(
        STATIONS, f'SELECT {_STATION_COLUMNS}, {_STATUS}, off AS "offset" FROM ev_silver'
    ),
    "gold_hourly": _with(
        GOLD,
        "SELECT * REPLACE (round(demand_forecast_error_pct, 6) AS demand_forecast_error_pct) "
        "FROM gold",
    ),
    "gold_forecast": _with(WEATHER, "SELECT * FROM wx_gold"),
    "gold_city": _with(STATIONS, "SELECT * FROM city_gold"),
    "mart_grid_hourly": _with(
        GOLD,
        "SELECT * REPLACE (round(demand_forecast_error_pct, 6) AS demand_forecast_error_pct) "
        "FROM grid",
    ),
    "authority_performance": _with(PERFORMANCE, "SELECT * FROM ranked_perf"),
    "served_authorities": _with(
        PERFORMANCE, "SELECT * FROM ranked_perf ORDER BY peak_demand_rank, respondent LIMIT 5"
    ),
    "city_rankings": _with(STATIONS, "SELECT * FROM city_mart"),
    "city_rankings_state": _with(
        STATIONS,
        "SELECT * FROM city_mart WHERE upper(state) = 'AS' "
        "ORDER BY national_station_rank, state, city LIMIT 25",
    ),
    "forecast_mart": _with(WEATHER_MART, "SELECT * FROM wx_mart"),
    "served_weather": _with(
        WEATHER_MART, "SELECT * FROM wx_mart ORDER BY location_key, period_start LIMIT 168"
    ),
    "grid_anomalies": _with(ANOMALIES, "SELECT * FROM anomalies"),
    "regional_signals": _with(
        SIGNALS,
        "SELECT * EXCLUDE (contains_replay) FROM regions "
        "ORDER BY pressure_score DESC, demand_vs_baseline_pct DESC, region LIMIT 25",
    ),
    "regional_history": _with(_region_history("ASIA"), "SELECT * FROM history"),
    "history_summary": _with(
        _region_history("EUROPE"),
        "SELECT round(avg(demand_mwh), 4) AS average_demand_mwh, "
        "max(demand_mwh) AS peak_demand_mwh, min(demand_mwh) AS minimum_demand_mwh, "
        "count(*) FILTER (contains_replay) AS replay_points FROM history",
    ),
    "regional_timeline": _with(TIMELINE, "SELECT * FROM regions"),
    "timeline_periods": _with(TIMELINE, "SELECT DISTINCT period FROM regions"),
    "timeline_frame": _with(
        TIMELINE, "SELECT * FROM regions WHERE period = TIMESTAMP '2000-06-01 00:00:00'"
    ),
    "severity_counts": _with(
        ANOMALIES, "SELECT severity, count(*) AS entities FROM anomalies GROUP BY severity"
    ),
    "peer_regions": _with(
        SIGNALS,
        "SELECT region, pressure_score, severity, demand_vs_baseline_pct FROM regions "
        "WHERE region <> 'EUROPE' ORDER BY pressure_score DESC, region LIMIT 6",
    ),
    "source_freshness": _with(FRESHNESS, "SELECT * FROM signals"),
    "freshness_counts": _with(
        FRESHNESS, "SELECT state, count(*) AS sources FROM signals GROUP BY state"
    ),
    "run_latest": _with(RUNS, "SELECT * FROM run_rows"),
    "run_recent": _with(RUNS, "SELECT * FROM run_rows ORDER BY started_at DESC, run_id LIMIT 200"),
    "run_summary": _with(
        RUNS,
        "SELECT count(*) AS total_runs, count(*) FILTER (status = 'STARTED') AS running_runs, "
        "count(*) FILTER (status = 'FAILED') AS failed_runs, "
        "count(*) FILTER (status = 'SUCCEEDED') AS successful_runs, "
        "max(finished_at) FILTER (status = 'SUCCEEDED') AS last_success_at FROM run_rows",
    ),
    "stage_telemetry": _with(RUNS, "SELECT * EXCLUDE (med, timed) FROM telemetry"),
    "stage_sla": _with(
        SLA,
        "SELECT * EXCLUDE (latest_records_processed), CASE status "
        "WHEN 'NO_RUN_DATA' THEN 'No run of this stage has been logged.' "
        "WHEN 'STALLED' THEN 'The running execution is over its runtime limit.' "
        "WHEN 'RUNNING' THEN 'The running execution is inside its runtime limit.' "
        "WHEN 'FAILED' THEN 'The latest run failed.' "
        "WHEN 'OVERDUE' THEN 'The latest success is older than the allowed age.' "
        "ELSE 'The latest run finished successfully.' END AS detail FROM sla",
    ),
    "operational_incidents": _with(INCIDENTS, "SELECT * FROM incidents"),
    "highest_severity": _with(
        INCIDENTS,
        "SELECT coalesce(arg_max(severity, CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' "
        "THEN 3 WHEN 'ELEVATED' THEN 2 ELSE 1 END), 'NORMAL') AS highest_severity FROM incidents",
    ),
    "lineage_nodes": _with(LINEAGE, "SELECT * FROM nodes"),
    "lineage_edges": _with(
        LINEAGE
        + """,
edge_list(edge_id, source_node, target_node, label) AS (
  VALUES ('eia-kafka', 'source-eia', 'kafka', 'grid events'),
    ('nws-kafka', 'source-nws', 'kafka', 'forecast events'),
    ('afdc-kafka', 'source-afdc', 'kafka', 'station events'),
    ('kafka-bronze', 'kafka', 'spark-bronze', 'stream'),
    ('bronze-silver', 'spark-bronze', 'spark-silver', 'transform'),
    ('silver-gold', 'spark-silver', 'spark-gold', 'aggregate'),
    ('gold-dbt', 'spark-gold', 'dbt', 'model'), ('dbt-duckdb', 'dbt', 'duckdb', 'serve'),
    ('duckdb-api', 'duckdb', 'fastapi', 'query'), ('api-ui', 'fastapi', 'nextjs', 'JSON API'))""",
        "SELECT e.*, a.state AS source_state, z.state AS target_state FROM edge_list e "
        "JOIN nodes a ON a.node_id = source_node JOIN nodes z ON z.node_id = target_node",
    ),
    "lineage_counts": _with(
        LINEAGE,
        "SELECT count(*) AS nodes, count(*) FILTER (state = 'HEALTHY') AS healthy, "
        "count(*) FILTER (state = 'DEGRADED') AS degraded, "
        "count(*) FILTER (state = 'UNHEALTHY') AS unhealthy, "
        "count(latest_run_status) AS instrumented FROM nodes",
    ),
    "worst_state": _with(
        LINEAGE,
        "SELECT arg_max(state, CASE state WHEN 'UNHEALTHY' THEN 3 WHEN 'DEGRADED' THEN 2 "
        "WHEN 'HEALTHY' THEN 1 ELSE 0 END) AS worst_state FROM nodes",
    ),
    "layer_counts": _with(LAYERS, "SELECT * FROM layers"),
    "data_quality": _with(
        LAYERS
        + """,
totals AS (
  SELECT CAST(sum(rows) FILTER (layer = 'BRONZE') AS BIGINT) AS bronze_rows,
    CAST(sum(rows) FILTER (layer = 'SILVER') AS BIGINT) AS silver_rows,
    CAST(sum(rows) FILTER (layer = 'GOLD') AS BIGINT) AS gold_rows,
    CAST(sum(rows) FILTER (layer = 'QUARANTINE') AS BIGINT) AS failure_rows,
    CAST(sum(rows) FILTER (layer = 'NOT_ROUTED') AS BIGINT) AS not_routed_rows FROM layers)""",
        "SELECT *, bronze_rows - silver_rows AS removed_before_silver, "
        "'BALANCED' AS conservation_state, "
        "round_even(silver_rows / CAST(bronze_rows AS DOUBLE) * 100, 3) AS silver_retention_pct, "
        "round_even(failure_rows / CAST(bronze_rows AS DOUBLE) * 100, 3) AS quality_failure_pct, "
        "bronze_rows - silver_rows - failure_rows AS deduplicated_rows, 'MEASURED' AS status "
        "FROM totals",
    ),
    "platform_status": _with(
        PERFORMANCE + "," + WEATHER + "," + STATIONS,
        "SELECT (SELECT count(*) FROM grid) AS grid_hourly_rows, "
        "(SELECT count(*) FROM perf) AS balancing_authorities, "
        "(SELECT count(*) FROM city_mart) AS ev_cities, "
        "(SELECT count(*) FROM wx_gold) AS weather_forecasts",
    ),
    "contract_violations": _with(
        LANDED,
        "SELECT snapshot, event_id AS position, missing_fields, unknown_fields, reason "
        "FROM judged WHERE reason IS NOT NULL",
    ),
    "contract_verdicts": _with(
        LANDED,
        "SELECT *, CASE WHEN reason IS NULL THEN 'PASSED' ELSE 'QUARANTINED' END AS verdict "
        "FROM verdicts",
    ),
    "contract_gate": _with(
        LANDED,
        "SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'quarantined' END AS side, reason, "
        "CAST(sum(record_count) AS BIGINT) AS records FROM verdicts GROUP BY ALL",
    ),
    "incremental_window": _with(
        WINDOWS,
        "SELECT respondent, watermark, window_start, window_end, "
        "date_diff('hour', window_start, window_end) + 1 AS hour_count FROM windows",
    ),
    "coverage_gaps": _with(WINDOWS, "SELECT * FROM gaps"),
    "watermark_advance": _with(
        WINDOWS,
        "SELECT w.respondent, count(g.period) AS missing_hours, "
        "CASE WHEN count(g.period) = 0 THEN window_end ELSE watermark END AS watermark "
        "FROM windows w LEFT JOIN gaps g ON g.respondent = w.respondent "
        "GROUP BY w.respondent, window_end, watermark",
    ),
    "replay_gaps": _with(REPLAY, "SELECT * FROM delays"),
    "replay_plan": _with(
        REPLAY,
        "SELECT 'replay-' || respondent || '-' || record_type || '-' "
        "|| strftime(period, '%Y-%m-%dT%H:%M:%S') AS event_id, 'eia' AS source, "
        "'eia_region_data' AS dataset, 'eia.region_data.observed' AS event_type, "
        "respondent AS partition_key, true AS replay, "
        "strftime(period, '%Y-%m-%dT%H:%M:%S') AS source_timestamp, period, respondent, "
        "record_type, delay_seconds, reading AS value FROM silver JOIN delays USING (period)",
    ),
    "flatten_electricity": _with(
        EVENTS
        + """,
both_records AS (
  SELECT *, record_type AS kind, value AS reading FROM ev
  UNION ALL SELECT *, 'K', CAST(k AS DOUBLE) FROM ev)""",
        "SELECT CAST(2 AS BIGINT) AS total_available, "
        "strftime(hour_ts, '%Y-%m-%dT%H') AS period, respondent, "
        "'Respondent ' || respondent AS respondent_name, kind AS record_type, "
        "event_type AS type_name, reading AS value, 'MegawattHours' AS value_units "
        "FROM both_records",
    ),
    "flatten_weather": _with(
        WEATHER,
        "SELECT latitude, longitude, strftime(period_start, '%Y-%m-%dT%H:%M:%SZ') AS period_start, "
        "strftime(period_start + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS period_end, "
        "l_quantity AS temperature, 'F' AS temperature_unit, precipitation_probability, "
        "CASE WHEN l_linenumber <> 4 THEN l_tax * CAST(1250 AS DOUBLE) END AS relative_humidity, "
        "wind_speed, l_returnflag AS wind_direction, l_linestatus AS short_forecast FROM wx_typed",
    ),
    "flatten_stations": _with(
        STATIONS,
        "SELECT CAST(1 AS BIGINT) AS total_available, key AS station_id, c_name AS station_name, "
        "key || ' Main St' AS street_address, city, state, zip_code, 'US' AS country, latitude, "
        "longitude, CASE WHEN key % 89 = 1 THEN 'LPG' ELSE 'ELEC' END AS fuel_type_code, "
        "CASE WHEN key % 83 = 2 THEN 'private' ELSE 'public' END AS access_code, "
        "CASE WHEN key % 79 = 4 THEN 'P' ELSE 'E' END AS status_code, ev_network, "
        "CASE WHEN key % 6 <> 0 THEN 'J1772,TESLA' ELSE '' END AS ev_connector_types, "
        "ev_level1_evse_num, ev_level2_evse_num, ev_dc_fast_num, 'GARAGE' AS facility_type, "
        "strftime(updated_at, '%Y-%m-%d') AS date_last_confirmed, "
        "strftime(updated_at, '%Y-%m-%dT%H:%M:%SZ') AS updated_at FROM ev_typed",
    ),
}

ORACLES["contract_violations_weather"] = _with(
    WEATHER,
    "SELECT * FROM (SELECT 'nation-' || s_nationkey AS snapshot, off AS position, "
    "CASE WHEN short_forecast = '' THEN 'empty_short_forecast' "
    "WHEN period_end <= period_start THEN 'invalid_forecast_interval' END AS reason "
    "FROM wx_typed) WHERE reason IS NOT NULL",
)
ORACLES["contract_violations_stations"] = _with(
    STATIONS,
    "SELECT * FROM (SELECT r_name AS snapshot, off AS position, "
    "CASE WHEN key % 89 = 1 THEN 'invalid_fuel_type_code' "
    "WHEN key % 83 = 2 THEN 'invalid_access_code' WHEN key % 79 = 4 THEN 'invalid_status_code' "
    "WHEN key % 6 = 0 THEN 'invalid_ev_connector_types' "
    "WHEN key % 97 = 3 THEN 'state_mismatch' END AS reason FROM ev_typed) "
    "WHERE reason IS NOT NULL",
)
ORACLES["normalised_weather"] = _with(
    WEATHER,
    "SELECT period_start, period_end, latitude, longitude, l_quantity AS temperature, "
    "precipitation_probability, relative_humidity, temperature_unit, wind_speed, "
    "l_returnflag AS wind_direction, short_forecast FROM wx_typed",
)
ORACLES["normalised_stations"] = _with(
    STATIONS,
    "SELECT key AS station_id, c_name AS station_name, city, zip_code, upper(state) AS state, "
    "'US' AS country, key || ' Main St' AS street_address, "
    "CASE WHEN key % 89 = 1 THEN 'LPG' ELSE 'ELEC' END AS fuel_type_code, "
    "CASE WHEN key % 83 = 2 THEN 'private' ELSE 'public' END AS access_code, "
    "CASE WHEN key % 79 = 4 THEN 'P' ELSE 'E' END AS status_code, ev_network, "
    "'GARAGE' AS facility_type, latitude, longitude, ev_level1_evse_num, ev_level2_evse_num, "
    "ev_dc_fast_num, CASE WHEN key % 6 <> 0 THEN 'J1772,TESLA' ELSE '' END AS ev_connector_types, "
    "CAST(updated_at AS DATE) AS date_last_confirmed, updated_at FROM ev_typed",
)
ORACLES["component_health"] = _with(
    COMPONENTS,
    "SELECT count(*) FILTER (status = 'healthy') AS healthy_components, "
    "count(*) AS components, CASE WHEN bool_or(status = 'unhealthy') THEN 'unhealthy' "
    "WHEN bool_or(status = 'degraded') THEN 'degraded' ELSE 'healthy' END AS platform_state "
    "FROM components",
)


# The codes of aggregates and what they stand for.
TYPES = """
types(respondent, entity_type, entity_name) AS (VALUES
  ('US48', 'national', 'United States Lower 48'), ('CAL', 'region', 'California'),
  ('CAR', 'region', 'Carolinas'), ('CENT', 'region', 'Central'), ('FLA', 'region', 'Florida'),
  ('MIDA', 'region', 'Mid-Atlantic'), ('MIDW', 'region', 'Midwest'),
  ('NE', 'region', 'New England'), ('NW', 'region', 'Northwest'), ('NY', 'region', 'New York'),
  ('SE', 'region', 'Southeast'), ('SW', 'region', 'Southwest'), ('TEN', 'region', 'Tennessee'),
  ('TEX', 'region', 'Texas'))"""


def _generic_tests() -> str:
    """Violation counts of the declared tests, one row per test."""
    risks = "'low', 'moderate', 'high', 'unknown'"
    plan = [
        (
            "mart_grid_hourly",
            "grid",
            "grid_hour_key period respondent entity_type contains_replay",
            "grid_hour_key",
            {"entity_type": "'balancing_authority', 'region', 'national'"},
        ),
        (
            "stg_eia_balancing_authority_hourly",
            "grid",
            "period respondent hour_of_day metric_count contains_replay",
            None,
            {},
        ),
        (
            "mart_balancing_authority_performance",
            "perf",
            "respondent observed_hours contains_replay",
            "respondent",
            {},
        ),
        ("mart_ev_city_rankings", "city_mart", "city_state_key city state station_count", "city_state_key", {}),
        ("stg_afdc_city_infrastructure", "city_mart", "city state country station_count", None, {}),
        (
            "mart_weather_forecast",
            "wx_full",
            "weather_forecast_key location_key period_start",
            "weather_forecast_key",
            {"precipitation_risk": risks},
        ),
        (
            "stg_nws_hourly_weather",
            "wx_full",
            "location_key period_start forecast_date",
            None,
            {"temperature_unit": "'F', 'C'", "precipitation_risk": risks},
        ),
        (
            "eia_respondent_types",
            "types",
            "respondent entity_type entity_name",
            "respondent",
            {"entity_type": "'region', 'national'"},
        ),
    ]
    rows = []
    for model, relation, nulls, key, accepted in plan:
        tests = {f"not_null:{c}": f"{c} IS NULL" for c in nulls.split()}
        tests |= {f"accepted_values:{c}": f"{c} NOT IN ({v})" for c, v in accepted.items()}
        rows += [
            f"SELECT '{model}' AS model, '{test}' AS test, "
            f"count(*) FILTER ({broken}) AS failures FROM {relation}"
            for test, broken in tests.items()
        ]
        if key:
            rows.append(
                f"SELECT '{model}', 'unique:{key}', count(*) FROM (SELECT {key} FROM {relation} "
                f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
            )
    keyed = """,
wx_full AS (
  SELECT *, location_key || '|' || CAST(period_start AS VARCHAR) AS weather_forecast_key
  FROM wx_gold)"""
    parts = PERFORMANCE + "," + WEATHER + "," + STATIONS + keyed + "," + TYPES
    return _with(parts, " UNION ALL ".join(rows))


ORACLES["dq_generic_tests"] = _generic_tests()
ORACLES["dq_singular_tests"] = _with(
    PERFORMANCE + "," + STATIONS + "," + TYPES,
    "SELECT 'ev_metrics_nonnegative' AS test, count(*) AS failures FROM city_mart "
    "WHERE least(station_count, level1_ports, level2_ports, dc_fast_ports, total_known_ports) < 0 "
    "UNION ALL SELECT 'forecast_coverage_bounds', count(*) FROM ranked_perf "
    "WHERE forecast_coverage_pct < 0 OR forecast_coverage_pct > 100 "
    "UNION ALL SELECT 'grid_forecast_error_math', count(*) FROM grid "
    "WHERE demand_mwh IS NOT NULL AND demand_forecast_mwh IS NOT NULL AND abs( "
    "demand_forecast_error_mwh - (demand_mwh - demand_forecast_mwh)) > 0.000001 "
    "UNION ALL SELECT 'no_aggregates_in_authorities', count(*) FROM perf "
    "WHERE respondent IN (SELECT respondent FROM types)",
)
