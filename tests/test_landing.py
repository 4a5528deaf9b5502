import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from amperline.operators import contracts, coverage, publish
from amperline.operators.envelope import parse_envelopes
from amperline.sources import landed

METRIC = {
    "period": "2026-08-10T05",
    "respondent": "PJM",
    "respondent-name": "PJM Interconnection",
    "type": "D",
    "type-name": "Demand",
    "value": 100.5,
    "value-units": "megawatthours",
}
FORECAST = {
    "latitude": 41.5,
    "longitude": -81.7,
    "period_start": "2026-08-10T01:00:00-04:00",
    "period_end": "2026-08-10T02:00:00-04:00",
    "temperature": 70.0,
    "temperature_unit": "F",
    "precipitation_probability": None,
    "relative_humidity": 40.0,
    "wind_speed": "5 mph",
    "wind_direction": "SW",
    "short_forecast": "Clear",
}
STATION = {
    "station_id": 1,
    "station_name": "Garage",
    "street_address": None,
    "city": "Cleveland",
    "state": "OH",
    "zip_code": "44114",
    "country": "US",
    "latitude": 41.5,
    "longitude": -81.7,
    "fuel_type_code": "ELEC",
    "access_code": "public",
    "status_code": "E",
    "ev_network": None,
    "ev_connector_types": ["J1772"],
    "ev_level1_evse_num": None,
    "ev_level2_evse_num": 2,
    "ev_dc_fast_num": None,
    "facility_type": None,
    "date_last_confirmed": "2026-07-01",
    "updated_at": "2026-07-10T10:00:00Z",
}


def without(record, name):
    return {k: v for k, v in record.items() if k != name}


def verdict(spark, contract, records, **metadata):
    described = {
        "source": contract.source,
        "dataset": contract.name,
        "schema_version": "1.0",
        "run_id": "r",
        "ingested_at": "2026-08-10T00:00:00Z",
        "record_count": len(records),
    }
    if contract.by_state:
        described |= {"query_state": "OH", "total_results": len(records)}
    described |= metadata
    text = json.dumps({"metadata": described, "records": records})
    documents = landed.snapshot_documents(
        spark.createDataFrame([("s", text)], "snapshot string, document string")
    )
    snapshots = documents.select("snapshot", "metadata")
    rows = landed.snapshot_records(documents)
    return contracts.validate_snapshots(snapshots, rows, contract).first()


@pytest.mark.parametrize(
    ("source", "records", "metadata", "reason"),
    [
        ("eia", [METRIC], {}, None),
        ("eia", [METRIC], {"record_count": 2}, "record_count_mismatch"),
        ("eia", [METRIC], {"record_count": "1"}, "record_count_not_integer"),
        ("eia", [{**METRIC, "extra": 1}], {}, "unknown_fields"),
        ("eia", [without(METRIC, "value")], {}, "missing_fields"),
        ("eia", [METRIC, METRIC], {}, "duplicate_unique_key"),
        ("eia", [{**METRIC, "period": "yesterday"}], {}, "invalid_period"),
        ("eia", [{**METRIC, "value": "12.5"}], {}, None),
        ("eia", [{**METRIC, "value": None}], {}, "invalid_value"),
        ("eia", [{**METRIC, "respondent": " "}], {}, "empty_respondent"),
        ("nws", [FORECAST], {}, None),
        ("nws", [FORECAST, FORECAST], {}, "duplicate_unique_key"),
        ("nws", [{**FORECAST, "x": 1}], {}, "unknown_fields"),
        ("nws", [without(FORECAST, "temperature")], {}, "missing_fields"),
        ("nws", [{**FORECAST, "period_start": "2026-08-10T01:00:00"}], {}, "invalid_period_start"),
        (
            "nws",
            [{**FORECAST, "period_end": FORECAST["period_start"]}],
            {},
            "invalid_forecast_interval",
        ),
        ("nws", [{**FORECAST, "latitude": 40}, {**FORECAST, "latitude": 40.0}], {}, "duplicate_unique_key"),
        ("eia", [METRIC, METRIC, {**METRIC, "period": "yesterday"}], {}, "duplicate_unique_key"),
        ("eia", [{**METRIC, "period": "yesterday"}, METRIC, METRIC], {}, "invalid_period"),
        ("afdc", [STATION], {}, None),
        ("afdc", [STATION, STATION], {}, "duplicate_unique_key"),
        ("afdc", [STATION], {"query_state": "NY"}, "state_mismatch"),
        ("afdc", [STATION], {"query_state": "O1"}, "invalid_query_state"),
        ("afdc", [STATION], {"total_results": 0}, "total_results_too_small"),
        ("afdc", [{**STATION, "z": 1}], {}, "unknown_fields"),
        ("afdc", [{**STATION, "ev_dc_fast_num": -1}], {}, "invalid_ev_dc_fast_num"),
        ("afdc", [{**STATION, "fuel_type_code": "LPG"}], {}, "invalid_fuel_type_code"),
        ("afdc", [{**STATION, "ev_connector_types": None}], {}, "invalid_ev_connector_types"),
    ],
)
def test_contract_verdicts(spark, source, records, metadata, reason):
    row = verdict(spark, contracts.CONTRACTS[source], records, **metadata)
    assert row.reason == reason
    assert row.verdict == ("PASSED" if reason is None else "QUARANTINED")
    assert row.record_count == len(records)


def test_a_document_without_records_fails(spark):
    described = {"source": "eia", "dataset": "d", "schema_version": "1", "run_id": "r"}
    described |= {"ingested_at": "2026-08-10T00:00:00Z", "record_count": 0}
    for records, reason in (({}, "missing_records"), ({"records": []}, None)):
        text = json.dumps({"metadata": described, **records})
        docs = landed.snapshot_documents(
            spark.createDataFrame([("s", text)], "snapshot string, document string")
        )
        found = contracts.validate_snapshots(
            docs.drop("records"), landed.snapshot_records(docs), contracts.ELECTRICITY_CONTRACT
        )
        assert found.first().reason == reason


def test_required_metadata_and_first_bad_record(spark):
    text = json.dumps({"metadata": {"source": "eia"}, "records": [METRIC]})
    docs = landed.snapshot_documents(
        spark.createDataFrame([("s", text), ("t", "[]")], "snapshot string, document string")
    )
    found = contracts.validate_snapshots(
        docs.select("snapshot", "metadata"),
        landed.snapshot_records(docs),
        contracts.ELECTRICITY_CONTRACT,
    )
    assert {r.snapshot: r.reason for r in found.collect()} == {
        "s": "missing_required_metadata",
        "t": "missing_metadata",
    }
    row = verdict(
        spark, contracts.ELECTRICITY_CONTRACT, [METRIC, {**METRIC, "x": 1}, without(METRIC, "type")]
    )
    assert row.reason == "unknown_fields"


def test_contract_from_mapping():
    loaded = {
        "dataset": {"name": "n"},
        "schema": {"fields": {"a": {}, "b": {}}},
        "quality": {"uniqueness": {"columns": ["a"]}},
        "metadata": {"required": ["run_id"]},
    }
    built = contracts.contract_from_mapping("eia", loaded)
    assert (built.fields, built.unique_key, built.required_metadata) == (
        ("a", "b"),
        ("a",),
        ("run_id",),
    )


def test_land_read_and_gate(spark, tmp_path):
    records = spark.createDataFrame([METRIC | {"value": "1.5"}]).select(
        *contracts.ELECTRICITY_CONTRACT.fields
    )
    root = str(tmp_path / "landing")
    options = dict(source="eia", dataset="d", ingested_at="2026-08-10T00:00:00Z")
    assert landed.land_snapshot(records, root, run_id="one", **options) == 1
    landed.land_snapshot(records.withColumn("x", F.lit(1)), root, run_id="two", **options)
    with pytest.raises(ValueError):
        landed.land_snapshot(records.limit(0), root, run_id="three", **options)
    with pytest.raises(Exception, match="(?i)exist"):
        landed.land_snapshot(records, root, run_id="one", **options)
    with pytest.raises(ValueError):
        landed.land_snapshot(records, root, run_id="s", query_state="O1", total_results=9, **options)
    snapshots, rows = landed.read_landed_runs(spark, root)
    accepted, rejected = contracts.gate(snapshots, rows, contracts.ELECTRICITY_CONTRACT)
    assert [r.snapshot for r in accepted.collect()] == ["one"]
    assert [(r.snapshot, r.reason) for r in rejected.collect()] == [("two", "unknown_fields")]


def test_snapshot_files(spark, tmp_path):
    folder = tmp_path / "ingestion_date=2026-08-10"
    folder.mkdir()
    (folder / "a.json").write_text(
        json.dumps({"metadata": {"run_id": "r"}, "records": [METRIC, METRIC]}, indent=2)
    )
    documents = landed.read_snapshots(spark, str(tmp_path))
    assert documents.first().snapshot.endswith("a.json")
    rows = landed.snapshot_records(documents).collect()
    assert [r.position for r in rows] == [0, 1] and json.loads(rows[0].record) == METRIC


def response(spark, body, **columns):
    frame = spark.createDataFrame([(json.dumps(body),)], "body string")
    return frame.withColumns({name: F.lit(value) for name, value in columns.items()})


def test_flatten_responses(spark):
    body = {"response": {"total": "2", "data": [METRIC | {"value": "7.5"}, METRIC | {"value": "x"}]}}
    found = landed.flatten_electricity(response(spark, body)).collect()
    assert [r.value for r in found] == [7.5, None] and found[0].total_available == 2
    assert found[0].respondent_name == "PJM Interconnection"
    period = {
        "startTime": "a",
        "endTime": "b",
        "temperature": 70,
        "temperatureUnit": "F",
        "probabilityOfPrecipitation": {"unitCode": "p", "value": None},
        "relativeHumidity": {"unitCode": "p", "value": 40},
        "windSpeed": "5 mph",
        "windDirection": "SW",
        "shortForecast": "Clear",
    }
    body = {"properties": {"periods": [period, period, {**period, "relativeHumidity": None}]}}
    located = response(spark, body, latitude=41.5, longitude=-81.7)
    found = landed.flatten_weather(located).collect()
    assert [r.relative_humidity for r in found] == [40.0, 40.0, None]
    assert found[0].precipitation_probability is None
    assert landed.flatten_weather(located, limit=2).count() == 2
    station = {"id": 9, "zip": "44114", "ev_connector_types": None, "state": "OH"}
    body = {"total_results": 31, "fuel_stations": [station]}
    row = landed.flatten_stations(response(spark, body)).first()
    assert (row.station_id, row.zip_code, row.ev_connector_types) == (9, "44114", [])
    assert row.total_available == 31


NOW = datetime(2026, 8, 10, 12, 30)


@pytest.mark.parametrize(
    ("watermark", "cap", "window"),
    [
        (datetime(2026, 8, 10, 7), None, (8, 10, 3)),
        (datetime(2026, 8, 10, 7), 2, (8, 9, 2)),
        (None, None, (1, 10, 10)),
        (datetime(2026, 8, 10, 10), None, None),
        (datetime(2026, 8, 11), None, None),
    ],
)
def test_next_window(spark, watermark, cap, window):
    state = spark.createDataFrame([(watermark,)], "watermark timestamp")
    row = coverage.next_window(
        state, NOW, datetime(2026, 8, 10, 1), max_window_hours=cap
    ).first()
    got = row and (row.window_start.hour, row.window_end.hour, row.hour_count)
    assert got == window


def test_window_parameters(spark):
    state = spark.createDataFrame([(None,)], "watermark timestamp")
    with pytest.raises(ValueError):
        coverage.next_window(state, NOW, NOW, safety_lag_hours=-1)
    with pytest.raises(ValueError):
        coverage.next_window(state, NOW, NOW, max_window_hours=0)


def test_a_missing_hour_holds_the_watermark(spark):
    state = spark.createDataFrame(
        [("a", datetime(2026, 8, 10, 7)), ("b", datetime(2026, 8, 10, 7))],
        "k string, watermark timestamp",
    )
    windows = coverage.next_window(state, NOW, NOW)
    received = spark.createDataFrame(
        [("a", datetime(2026, 8, 10, h)) for h in (8, 9, 10)]
        + [("b", datetime(2026, 8, 10, h)) for h in (8, 10)],
        "k string, period timestamp",
    )
    gaps = coverage.coverage_gaps(windows, received, ["k"]).collect()
    assert [(r.k, r.period.hour) for r in gaps] == [("b", 9)]
    moved = {r.k: r for r in coverage.advance(windows, received, ["k"]).collect()}
    assert moved["a"].watermark.hour == 10 and moved["b"].watermark.hour == 7
    assert moved["b"].missing_hours == 1


def history(spark, *periods):
    return spark.createDataFrame(
        [(p, r, "n", t, "tn", 1.0, "mwh") for p in periods for r in ("B", "A") for t in ("NG", "D")],
        "period timestamp, respondent string, respondent_name string, record_type string, "
        "type_name string, value double, value_units string",
    )


def test_replay_order_tags_and_delays(spark):
    first = datetime(2025, 12, 31, 22)
    periods = [first, first + timedelta(hours=1), first + timedelta(hours=5), first + timedelta(days=90)]
    records = history(spark, *reversed(periods))
    gaps = {r.period: r.delay_seconds for r in publish.replay_gaps(records, 3600.0).collect()}
    assert [gaps[p] for p in periods] == [None, 1.0, 4.0, 90 * 24 - 5.0]
    plan = publish.replay_plan(records, "2026-08-10T00:00:00Z", 3600.0).collect()
    keys = [(r.period, r.respondent, r.record_type) for r in plan]
    assert keys == sorted(keys) and len(keys) == 16 and all(r.replay for r in plan)
    assert len({r.event_id for r in plan}) == 16
    with pytest.raises(ValueError):
        publish.replay_gaps(records, 0)


def test_published_message_is_a_valid_envelope(spark):
    ready = publish.envelopes(
        history(spark, datetime(2026, 8, 10, 5)).limit(1), "eia", "2026-08-10T06:00:00Z"
    )
    message = publish.bus_messages(ready, "x.eia.region-data.v1")
    text = bytes(message.first().value).decode()
    assert list(json.loads(text)) == sorted(json.loads(text)) and ": " not in text
    parsed = parse_envelopes(
        message.withColumns(
            {
                "partition": F.lit(0),
                "offset": F.lit(1).cast("long"),
                "timestamp": F.lit(None).cast("timestamp"),
            }
        )
    ).first()
    assert parsed.is_valid and parsed.source_timestamp == "2026-08-10T05:00:00"
    with pytest.raises(ValueError):
        publish.bus_messages(ready, " ")


def test_partition_keys_and_station_timestamps(spark):
    frame = spark.createDataFrame(
        [("OH", datetime(2026, 7, 10), None), ("NY", None, datetime(2026, 7, 1)), ("TX", None, None)],
        "state string, updated_at timestamp, date_last_confirmed timestamp",
    ).withColumn("date_last_confirmed", F.to_date("date_last_confirmed"))
    found = publish.envelopes(frame, "afdc", "2026-08-10T00:00:00Z").collect()
    assert [(r.partition_key, r.source_timestamp) for r in found] == [
        ("OH", "2026-07-10T00:00:00+00:00"),
        ("NY", "2026-07-01"),
        ("TX", None),
    ]


def test_date_of_an_offset_text_is_the_written_one(spark):
    record = json.dumps({**STATION, "date_last_confirmed": "2026-07-10T23:00:00-05:00"})
    rows = spark.createDataFrame([(record,)], "record string")
    assert str(contracts.normalised_stations(rows).first().date_last_confirmed) == "2026-07-10"
