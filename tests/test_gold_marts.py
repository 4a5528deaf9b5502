from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from amperline.operators import gold, marts

GRID_SILVER = (
    "period timestamp, period_date date, respondent string, respondent_name string, "
    "record_type string, value double, kafka_timestamp timestamp, replay boolean, "
    "quality_status string"
)
HOUR = datetime(2026, 8, 10, 5)


def metrics(spark, *entries):
    rows = [
        (HOUR, HOUR.date(), "PJM", "PJM", kind, value, HOUR, replay, status)
        for kind, value, replay, status in entries
    ]
    return spark.createDataFrame(rows, GRID_SILVER)


def test_hourly_pivot(spark):
    silver = metrics(
        spark,
        ("D", 100.0, False, "PASS"),
        ("DF", 80.0, False, "PASS"),
        ("NG", 110.0, True, "PASS"),
        ("TI", -5.0, False, "PASS"),
    )
    row = gold.hourly_grid(silver).first()
    assert row.demand_forecast_error_mwh == 20 and row.demand_forecast_error_pct == 25
    assert row.generation_demand_gap_mwh == 10 and row.metric_count == 4
    assert row.has_demand and row.has_demand_forecast and row.has_generation
    assert row.has_interchange and row.contains_replay and row.hour_of_day == 5


def test_zero_forecast_has_no_percentage(spark):
    row = gold.hourly_grid(
        metrics(spark, ("D", 10.0, False, "PASS"), ("DF", 0.0, False, "PASS"))
    ).first()
    assert row.demand_forecast_error_mwh == 10 and row.demand_forecast_error_pct is None


def test_failed_rows_do_not_count(spark):
    row = gold.hourly_grid(
        metrics(spark, ("D", 10.0, False, "PASS"), ("NG", 999999.0, False, "FAIL"))
    ).first()
    assert row.net_generation_mwh is None and row.metric_count == 1


@pytest.mark.parametrize(
    ("degrees", "unit", "rain", "fahrenheit", "celsius", "band"),
    [
        (68.0, "F", 28.0, 68.0, 20.0, "moderate"),
        (20.0, "C", 70.0, 68.0, 20.0, "high"),
        (50.0, "F", None, 50.0, 10.0, "unknown"),
        (50.0, "F", 19.9, 50.0, 10.0, "low"),
    ],
)
def test_weather_units_and_bands(spark, degrees, unit, rain, fahrenheit, celsius, band):
    silver = spark.createDataFrame(
        [(41.5, -81.7, HOUR, HOUR, HOUR.date(), degrees, unit, rain, 50.0, "5 mph", "SW", "Clear",
          "e", False, "t", 0, 1, HOUR, "PASS")],
        "latitude double, longitude double, period_start timestamp, period_end timestamp, "
        "forecast_date date, temperature double, temperature_unit string, "
        "precipitation_probability double, relative_humidity double, wind_speed string, "
        "wind_direction string, short_forecast string, event_id string, replay boolean, "
        "topic string, partition int, offset bigint, kafka_timestamp timestamp, "
        "quality_status string",
    )
    row = gold.hourly_weather(silver).first()
    assert row.location_key == "41.5000,-81.7000" and row.precipitation_risk == band
    assert (row.temperature_f, row.temperature_c) == (fahrenheit, celsius)


STATIONS = (
    "city string, state string, country string, station_id bigint, ev_level1_evse_num int, "
    "ev_level2_evse_num int, ev_dc_fast_num int, ev_network string, updated_at timestamp, "
    "quality_status string"
)


def test_city_infrastructure(spark):
    silver = spark.createDataFrame(
        [
            ("Cleveland", "OH", "US", 1, 1, 4, 2, "A", datetime(2026, 7, 9), "PASS"),
            ("Cleveland", "OH", "US", 2, None, 2, None, "B", datetime(2026, 7, 10, 10), "PASS"),
            ("Cleveland", "OH", "US", 3, 50, 50, 50, "C", datetime(2026, 7, 11), "FAIL"),
        ],
        STATIONS,
    )
    row = gold.city_infrastructure(silver).first()
    assert (row.station_count, row.level1_ports, row.level2_ports, row.dc_fast_ports) == (2, 1, 6, 2)
    assert row.total_known_ports == 9 and row.ports_per_station == 4.5
    assert row.dc_fast_station_count == 1 and row.dc_fast_station_share_pct == 50
    assert row.network_count == 2 and row.latest_station_update == datetime(2026, 7, 10, 10)


def test_known_aggregates_are_classified(spark):
    silver = metrics(spark, ("D", 1.0, False, "PASS"))
    both = silver.unionByName(silver.withColumn("respondent", F.lit("TEX")))
    mart = marts.grid_hourly(gold.hourly_grid(both), marts.respondent_types(spark))
    assert mart.columns == list(marts.GRID_COLUMNS)
    kinds = {r.respondent: (r.entity_type, r.grid_hour_key) for r in mart.collect()}
    assert kinds["PJM"] == ("balancing_authority", "PJM|2026-08-10 05:00:00")
    assert kinds["TEX"][0] == "region"


def test_seed_file_replaces_the_built_in_dimension(spark, tmp_path):
    seed = tmp_path / "types.csv"
    seed.write_text("respondent,entity_type,entity_name\nPJM,region,Test\n")
    assert marts.respondent_types(spark, str(seed)).first().entity_name == "Test"
    assert marts.respondent_types(spark).count() == 14


def test_authority_performance_ranks_with_ties_and_nulls(spark):
    rows = [
        # respondent, demand, forecast, generation
        ("A", 100.0, 80.0, 90.0),
        ("B", 100.0, 80.0, None),
        ("C", 300.0, None, None),
        ("D", None, None, 5.0),
    ]
    grid = spark.createDataFrame(
        [(HOUR, r, "balancing_authority", d, f, g, False, HOUR) for r, d, f, g in rows],
        "period timestamp, respondent string, entity_type string, demand_mwh double, "
        "demand_forecast_mwh double, net_generation_mwh double, contains_replay boolean, "
        "latest_kafka_timestamp timestamp",
    ).withColumns({"respondent_name": F.col("respondent"), "total_interchange_mwh": F.lit(None)})
    found = {
        r.respondent: r
        for r in marts.authority_performance(grid.withColumns(gold.hourly_measures())).collect()
    }
    assert [found[x].peak_demand_rank for x in "ABCD"] == [2, 2, 1, 3]
    assert [found[x].forecast_accuracy_rank for x in "ABCD"] == [1, 1, 2, 2]
    assert found["B"].generation_coverage_pct == 0 and found["D"].forecast_coverage_pct is None
    assert found["A"].mean_abs_forecast_error_pct == pytest.approx(25.0)


def test_city_rankings_null_city_and_country(spark):
    base = dict(
        level1_ports=1, level2_ports=1, dc_fast_ports=1, dc_fast_station_count=1, network_count=1,
        latest_station_update=HOUR, ports_per_station=1.0, dc_fast_station_share_pct=1.0,
    )
    rows = [
        dict(city="B", state="OH", country="US", station_count=5, total_known_ports=9, **base),
        dict(city="A", state="OH", country=None, station_count=5, total_known_ports=9, **base),
        dict(city=None, state="OH", country="US", station_count=5, total_known_ports=9, **base),
        dict(city="Z", state="TX", country="US", station_count=9, total_known_ports=3, **base),
    ]
    ranked = {r.city: r for r in marts.city_rankings(spark.createDataFrame(rows)).collect()}
    assert ranked["A"].city_state_key == "A|OH|"
    assert [ranked[c].state_station_rank for c in ("A", "B", None)] == [1, 2, 3]
    assert [ranked[c].national_station_rank for c in ("Z", "A", "B", None)] == [1, 2, 3, 4]
    assert ranked["Z"].state_port_rank == 1


def test_forecast_sequence_runs_across_days(spark):
    hours = [datetime(2026, 8, day, hour) for day in (1, 2, 4) for hour in (0, 5, 23)]
    rows = [("k", h, h.date()) for h in reversed(hours)] + [("other", hours[4], date(2026, 8, 2))]
    frame = spark.createDataFrame(rows, "location_key string, period_start timestamp, forecast_date date")
    filler = {
        name: F.lit(None).cast("string")
        for name in (*marts.WEATHER_COLUMNS, "partition", "offset")
        if name not in ("location_key", "period_start", "forecast_date", "forecast_sequence")
    }
    mart = marts.weather_forecast(frame.withColumns(filler))
    got = {(r.location_key, r.period_start): r.forecast_sequence for r in mart.collect()}
    assert [got["k", h] for h in hours] == list(range(1, 10)) and got["other", hours[4]] == 1


def test_location_key_rounds_exact_ties_to_even(spark):
    rows = spark.createDataFrame(
        [(12.28125, -1234.5, 1), (-81.7, 0.0, 2), (None, 1.0, 3)], "latitude double, longitude double, n int"
    )
    found = rows.select(gold.location_key().alias("k"), "n").orderBy("n").collect()
    assert [r.k for r in found] == ["12.2812,-1234.5000", "-81.7000,0.0000", None]
