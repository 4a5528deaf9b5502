import json
from datetime import datetime

import pytest

from amperline.operators import typed

BRONZE = (
    "source string, event_id string, event_version string, event_type string, "
    "partition_key string, emitted_at string, replay boolean, source_timestamp string, "
    "topic string, partition int, offset bigint, kafka_timestamp timestamp, kafka_key string, "
    "payload_json string"
)
METRIC = {
    "period": "2026-08-10T05:00:00",
    "record_type": "D",
    "respondent": "PJM",
    "respondent_name": "PJM Interconnection",
    "type_name": "Demand",
    "value": 3400.0,
    "value_units": "megawatthours",
}
FORECAST = {
    "latitude": 41.5,
    "longitude": -81.7,
    "period_start": "2026-08-10T01:00:00-04:00",
    "period_end": "2026-08-10T02:00:00-04:00",
    "temperature": 68,
    "temperature_unit": "F",
    "precipitation_probability": None,
    "relative_humidity": 55,
    "wind_speed": "5 mph",
    "wind_direction": "SW",
    "short_forecast": "Clear",
}
STATION = {
    "station_id": 7,
    "station_name": "Garage",
    "city": "Cleveland",
    "state": "OH",
    "zip_code": "44114",
    "country": "US",
    "latitude": 41.5,
    "longitude": -81.7,
    "fuel_type_code": "ELEC",
    "access_code": "public",
    "status_code": "E",
    "ev_connector_types": ["J1772"],
    "ev_level2_evse_num": 2,
    "date_last_confirmed": "2026-07-01",
    "updated_at": "2026-07-10T10:00:00Z",
}


def bronze(spark, source, *entries):
    rows = []
    for payload, offset, emitted in entries:
        text = payload if isinstance(payload, str) else json.dumps(payload)
        rows.append(
            (source, f"e{offset}", "1.0", "t", "k", emitted, False, None, "topic", 0, offset,
             datetime(2026, 8, 10, 6), "k", text)
        )
    return spark.createDataFrame(rows, BRONZE)


def one(spark, source, payload):
    return bronze(spark, source, (payload, 1, "2026-08-10T06:00:00Z"))


@pytest.mark.parametrize(
    ("change", "code"),
    [
        ({}, None),
        ({"period": "garbage"}, "invalid_period"),
        ({"respondent": " "}, "invalid_respondent"),
        ({"record_type": None}, "invalid_record_type"),
        ({"value": None}, "invalid_value"),
        ({"value_units": ""}, "invalid_value_units"),
    ],
)
def test_electricity_rules(spark, change, code):
    row = typed.electricity(one(spark, "eia", {**METRIC, **change})).first()
    assert row.quality_error == code
    assert row.quality_status == ("FAIL" if code else "PASS") and row.is_valid == (code is None)


@pytest.mark.parametrize(
    ("change", "code"),
    [
        ({}, None),
        ({"latitude": 91}, "invalid_latitude"),
        ({"longitude": None}, "invalid_longitude"),
        ({"period_start": "soon"}, "invalid_period_start"),
        ({"period_end": None}, "invalid_period_end"),
        ({"period_end": FORECAST["period_start"]}, "invalid_period_range"),
        ({"temperature": None}, "invalid_temperature"),
        ({"temperature_unit": "K"}, "invalid_temperature_unit"),
        ({"precipitation_probability": 101}, "invalid_precipitation_probability"),
        ({"relative_humidity": -1}, "invalid_relative_humidity"),
        ({"short_forecast": " "}, "invalid_short_forecast"),
    ],
)
def test_weather_rules(spark, change, code):
    row = typed.weather(one(spark, "nws", {**FORECAST, **change})).first()
    assert row.quality_error == code


def test_weather_offset_becomes_utc(spark):
    row = typed.weather(one(spark, "nws", FORECAST)).selectExpr(
        "CAST(period_start AS STRING) s", "forecast_date"
    )
    assert tuple(map(str, row.first())) == ("2026-08-10 05:00:00", "2026-08-10")


@pytest.mark.parametrize(
    ("change", "code"),
    [
        ({}, None),
        ({"station_id": 0}, "invalid_station_id"),
        ({"station_name": None}, "invalid_station_name"),
        ({"latitude": -90.5}, "invalid_latitude"),
        ({"longitude": 181}, "invalid_longitude"),
        ({"state": "OHIO"}, "invalid_state"),
        ({"fuel_type_code": "LPG"}, "invalid_fuel_type"),
        ({"access_code": "private"}, "invalid_access_code"),
        ({"status_code": None}, "invalid_status_code"),
    ],
)
def test_station_rules(spark, change, code):
    row = typed.stations(one(spark, "afdc", {**STATION, **change})).first()
    assert row.quality_error == code


def test_fractional_port_count_is_not_an_integer(spark):
    row = typed.stations(one(spark, "afdc", {**STATION, "ev_dc_fast_num": 1.5})).first()
    assert row.ev_dc_fast_num is None and row.ev_level2_evse_num == 2


def test_other_sources_are_left_out(spark):
    assert typed.electricity(one(spark, "platform", METRIC)).count() == 0


def test_newest_offset_wins_for_one_hour(spark):
    rows = bronze(
        spark,
        "eia",
        (METRIC, 10, "2026-08-10T06:00:00Z"),
        ({**METRIC, "value": 3500.0}, 11, "2026-08-10T06:00:00Z"),
        ({**METRIC, "value": None}, 12, "2026-08-10T07:00:00Z"),
    )
    kept = typed.latest_valid(typed.electricity(rows), typed.ELECTRICITY).collect()
    assert [(r.value, r.offset) for r in kept] == [(3500.0, 11)]


def test_update_time_beats_emission_time_for_stations(spark):
    rows = bronze(
        spark,
        "afdc",
        ({**STATION, "updated_at": "2026-07-09T10:00:00Z"}, 30, "2026-08-10T09:00:00Z"),
        (STATION, 31, "2026-08-10T06:00:00Z"),
    )
    kept = typed.latest_valid(typed.stations(rows), typed.STATIONS).collect()
    assert [r.offset for r in kept] == [31]


def test_quarantine_has_one_shape(spark):
    rejected = typed.quarantined(
        {
            "eia": typed.electricity(one(spark, "eia", {**METRIC, "value": None})),
            "nws": typed.weather(one(spark, "nws", FORECAST)),
            "afdc": typed.stations(one(spark, "afdc", {**STATION, "status_code": "P"})),
        }
    )
    assert rejected.columns == list(typed.QUARANTINE_COLUMNS)
    assert sorted((r.source, r.quality_error) for r in rejected.collect()) == [
        ("afdc", "invalid_status_code"),
        ("eia", "invalid_value"),
    ]


def test_filter_does_not_repeat_the_json_parse(spark):
    silver = typed.latest_valid(typed.electricity(one(spark, "eia", METRIC)), typed.ELECTRICITY)
    plan = silver._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
