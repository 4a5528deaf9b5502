import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from amperline.operators.envelope import invalid_envelopes, parse_envelopes, valid_envelopes
from amperline.operators.publish import dead_letters
from amperline.sources.schemas import RECORD, topic
from amperline.streaming.outcomes import outcome_counts, outcome_rate

GOOD = {
    "event_id": "b1f0",
    "event_version": "1.0",
    "source": "eia",
    "dataset": "eia_region_data",
    "event_type": "eia.region_data.observed",
    "partition_key": "PJM",
    "emitted_at": "2026-08-10T06:00:00+00:00",
    "replay": True,
    "source_timestamp": "2026-08-10T05:00:00",
    "payload": {"respondent": "PJM", "value": 1000.0, "nested": {"a": [1, 2]}},
}


def records(spark, *values, moment=datetime(2026, 8, 10, 6)):
    rows = [
        ("t", 0, i, moment, b"PJM", v if isinstance(v, bytes) else json.dumps(v).encode())
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, RECORD)


def test_valid_envelope_is_flattened(spark):
    row = parse_envelopes(records(spark, GOOD)).first()
    assert row.is_valid and row.validation_error is None
    assert (row.event_id, row.source, row.replay) == ("b1f0", "eia", True)
    assert row.kafka_key == "PJM" and str(row.kafka_date) == "2026-08-10"
    assert json.loads(row.payload_json) == GOOD["payload"]


def test_payload_text_equals_the_extracted_path(spark):
    parsed = parse_envelopes(records(spark, GOOD, {**GOOD, "payload": {"v": "1.10", "n": 1.10}}))
    different = parsed.where(
        ~F.col("payload_json").eqNullSafe(F.get_json_object("event_json", "$.payload"))
    )
    assert different.count() == 0


@pytest.mark.parametrize(
    ("change", "code"),
    [
        ({"event_id": " "}, "missing_or_invalid_event_id"),
        ({"event_version": "2.0"}, "unsupported_event_version"),
        ({"source": "unknown"}, "missing_or_invalid_source"),
        ({"dataset": None}, "missing_or_invalid_dataset"),
        ({"event_type": ""}, "missing_or_invalid_event_type"),
        ({"partition_key": "  "}, "missing_or_invalid_partition_key"),
        ({"emitted_at": None}, "missing_or_invalid_emitted_at"),
        ({"replay": "yes"}, "missing_or_invalid_replay"),
        ({"payload": None}, "missing_or_invalid_payload"),
        ({"event_id": None, "payload": None}, "missing_or_invalid_event_id"),
    ],
)
def test_first_broken_rule_is_reported(spark, change, code):
    row = parse_envelopes(records(spark, {**GOOD, **change})).first()
    assert row.validation_error == code and row.is_valid is False


def test_malformed_json_and_missing_time(spark):
    row = parse_envelopes(records(spark, b"{invalid-json", moment=None)).first()
    assert row.validation_error == "missing_or_invalid_event_id"
    assert row.kafka_date is None and row.event_json == "{invalid-json"


def test_split_and_outcomes(spark):
    parsed = parse_envelopes(records(spark, GOOD, GOOD, {**GOOD, "source": "platform"}, b"x"))
    assert valid_envelopes(parsed).count() == 3
    assert invalid_envelopes(parsed).count() == 1
    totals = {(r.source, r.outcome): r.messages for r in outcome_counts(parsed).collect()}
    assert totals == {
        ("eia", "processed"): 2,
        ("platform", "processed"): 1,
        ("unknown", "dead_lettered"): 1,
    }
    rates = {r.source: r.messages_per_second for r in outcome_rate(parsed).collect()}
    assert rates["eia"] == pytest.approx(2 / 60)


def test_dead_letter_keeps_the_original(spark):
    invalid = invalid_envelopes(parse_envelopes(records(spark, b"oops")))
    row = dead_letters(invalid, F.lit("2026-08-10T07:00:00Z"), "demo").first()
    letter = json.loads(bytes(row.value))
    assert row.topic == topic("dead_letter", "demo") and bytes(row.key) == b"t"
    assert list(letter) == sorted(letter)
    assert letter["source"] == "platform" and letter["replay"] is False
    assert letter["payload"]["raw_value"] == "oops"
    assert letter["payload"]["failure_reason"] == "missing_or_invalid_event_id"
    assert letter["payload"]["original_offset"] == 0
