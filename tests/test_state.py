"""State that outlives a run: control tables, increments, landed runs, offset ranges, the log of outcomes."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from amperline.operators.coverage import advance_control
from amperline.operators.envelope import parse_envelopes
from amperline.plans import increments, medallion
from amperline.plans.compaction import compact_bronze
from amperline.sources import bus, commits, landed
from amperline.sources.control import ControlTable, OutdatedVersion
from amperline.sources.schemas import BRONZE, RECORD
from amperline.sources.tables import read_layer, write_layer
from amperline.streaming.bronze import bronze_batch
from amperline.streaming.outcomes import HandlerFailed, OutcomeLog, read_totals, start_totals

STATE = "respondent string, watermark timestamp"


def hour(number):
    return datetime(2026, 8, 10, number)


def test_one_of_two_writers_commits(spark, tmp_path):
    first, second = (ControlTable(spark, f"{tmp_path}/control", STATE) for _ in range(2))
    assert first.read()[0] == 0 and first.read()[1].count() == 0
    rows = spark.createDataFrame([("A", hour(3))], STATE)
    seen = second.version()
    assert first.commit(rows, 0, {"why": "start"}) == 1
    with pytest.raises(OutdatedVersion):
        second.commit(rows.limit(0), seen)
    version, stored = second.read()
    assert version == 1 and [tuple(r) for r in stored.collect()] == [("A", hour(3))]
    assert second.note(1)["why"] == "start"
    assert second.commit(rows.limit(0), 1) == 2
    assert first.read(1)[1].count() == 1 and first.read()[1].count() == 0
    with pytest.raises(ValueError):
        first.read(9)


def test_a_name_is_published_once_and_nothing_stays_behind(spark, tmp_path):
    path = f"{tmp_path}/place/name.json"
    assert commits.publish_once(spark, path, {"a": 1}) and not commits.publish_once(spark, path, {"a": 2})
    assert commits.read_published(spark, path) == {"a": 1}
    assert commits.listed(spark, f"{tmp_path}/place") == ["name.json"]
    assert [p.name for p in (tmp_path / "place").iterdir() if p.suffix != ".crc"] == ["name.json"]
    assert commits.read_published(spark, f"{path}2") is None and commits.listed(spark, f"{path}3") == []


def test_watermark_advances_only_over_whole_windows(spark, tmp_path):
    table = ControlTable(spark, f"{tmp_path}/control", STATE)
    table.commit(spark.createDataFrame([("A", hour(3)), ("B", hour(3)), ("C", None), ("D", hour(20))], STATE), 0)
    received = [("A", hour(h)) for h in range(4, 9)] + [("B", hour(h)) for h in (4, 6)] + [("C", hour(1))]
    received = spark.createDataFrame(received, "respondent string, period timestamp")
    options = dict(safety_lag_hours=2, max_window_hours=2)

    def step():
        report = advance_control(table, ["respondent"], received, hour(12), hour(1), **options).collect()
        return {r.respondent: (r.window_start.hour, r.window_end.hour, r.missing_hours, r.version) for r in report}

    assert step() == {"A": (4, 5, 0, 2), "B": (4, 5, 1, 2), "C": (1, 2, 1, 2)}
    assert step() == {"A": (6, 7, 0, 3), "B": (4, 5, 1, 3), "C": (1, 2, 1, 3)}
    assert step() == {"A": (8, 9, 1, 3), "B": (4, 5, 1, 3), "C": (1, 2, 1, 3)}
    state = {r.respondent: r.watermark for r in table.read()[1].collect()}
    assert state == {"A": hour(7), "B": hour(3), "C": None, "D": hour(20)}


# Increments ----------------------------------------------------------------------------


def bronze_row(source, offset, payload, emitted="2026-08-10T06:00:00Z"):
    return {
        "topic": "t", "partition": 0, "offset": offset, "kafka_timestamp": hour(6), "kafka_key": "k",
        "event_json": None, "event_id": f"e{offset}", "event_version": "1.0", "dataset": "d",
        "event_type": "x", "partition_key": "k", "emitted_at": emitted, "replay": False,
        "source_timestamp": None, "payload_json": json.dumps(payload), "source": source,
        "kafka_date": hour(6).date(),
    }


def reading(offset, day, value, respondent="PJM"):
    payload = {
        "period": f"2026-08-{day:02d}T05:00:00", "record_type": "D", "respondent": respondent,
        "respondent_name": "n", "type_name": "Demand", "value": value, "value_units": "MWh",
    }
    return bronze_row("eia", offset, payload)


def station(offset, key, state, updated):
    payload = {
        "station_id": key, "station_name": "n", "city": "c", "state": state, "country": "US",
        "latitude": 1.0, "longitude": 2.0, "fuel_type_code": "ELEC", "access_code": "public",
        "status_code": "E", "updated_at": updated,
    }
    return bronze_row("afdc", offset, payload)


def batch(spark, root, name, rows):
    frame = spark.createDataFrame([row | {"batch_id": name} for row in rows], BRONZE)
    write_layer(frame, root, "bronze_events", only_touched=True)


FIRST = [
    reading(1, 10, 5.0),
    reading(2, 11, 6.0),
    reading(3, 12, None),
    station(4, 1, "OH", "2026-01-02T00:00:00Z"),
    station(5, 2, "NY", "2026-01-02T00:00:00Z"),
    station(6, 3, "OH/X"[:2], "2026-01-02T00:00:00Z"),
    station(7, 4, "TX", "2026-01-02T00:00:00Z"),
]
LATER = [
    reading(11, 10, 50.0),
    reading(12, 13, 8.0),
    reading(13, 14, None),
    station(14, 2, "CA", "2026-01-03T00:00:00Z"),
    station(15, 1, "NY", "2026-01-01T00:00:00Z"),
]


def content(spark, root):
    names = [*medallion.SILVER_TABLES, *medallion.GOLD_TABLES, "silver_quarantine"]
    tables = {n: read_layer(spark, root, n) for n in names}
    return {n: sorted(map(str, t.select(*sorted(t.columns)).collect())) for n, t in tables.items()}


def files(root, name):
    return {str(p): p.stat().st_mtime_ns for p in Path(root, name).rglob("part-*.parquet")}


def test_increment_equals_rebuild_and_leaves_other_files_alone(spark, tmp_path):
    root, whole = f"{tmp_path}/lake", f"{tmp_path}/whole"
    batch(spark, root, "one", FIRST)
    assert increments.increment(spark, root)["silver_stations"] == {"rows": 4}  # first build
    assert increments.increment(spark, root) == {}
    before = {n: files(root, n) for n in ("silver_electricity", "silver_stations", "gold_hourly", "gold_city")}
    batch(spark, root, "two", LATER)
    report = increments.increment(spark, root)
    assert [d.day for d in report["silver_electricity"]["partitions"]] == [10, 13]
    assert report["silver_stations"]["partitions"] == ["CA", "NY", "OH"]
    assert "silver_weather" not in report and report["silver_quarantine"] == {"rows": 1}
    for name, old in before.items():
        now = files(root, name)
        kept = {p for p in old if "period_date=2026-08-11" in p or "state=TX" in p}
        assert kept and all(now[p] == old[p] for p in kept)
        assert not any("state=NY" in p for p in now)  # its only station moved away
    for name, rows in (("one", FIRST), ("two", LATER)):
        batch(spark, whole, name, rows)
    increments.rebuild(spark, whole)
    assert content(spark, root) == content(spark, whole)
    assert increments.increment(spark, root) == {}


def test_increment_that_broke_off_is_repeated(spark, tmp_path, monkeypatch):
    root, whole = f"{tmp_path}/lake", f"{tmp_path}/whole"
    for place in (root, whole):
        batch(spark, place, "one", FIRST)
        increments.rebuild(spark, place)
        batch(spark, place, "two", LATER)

    def refuse(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ControlTable, "commit", refuse)
        with pytest.raises(RuntimeError):
            increments.increment(spark, root)
    increments.increment(spark, root)
    increments.increment(spark, whole)
    assert content(spark, root) == content(spark, whole)


def test_merge_of_closed_dates(spark, tmp_path):
    root = str(tmp_path)
    old = [row | {"kafka_date": hour(6).date().replace(day=d)} for row, d in ((reading(i, 10, 1.0), i) for i in (1, 2))]
    for number in range(3):
        batch(spark, root, f"s-{number}", [r | {"offset": r["offset"] + 100 * number} for r in old])
    increments.rebuild(spark, root)
    batch(spark, root, "s-3", [r | {"offset": r["offset"] + 900, "event_id": "late"} for r in old])

    def folders():
        return sorted("/".join(p.parts[-2:]) for p in tmp_path.glob("bronze_events/*/*/batch_id=*"))

    def offsets():
        return sorted(r.offset for r in read_layer(spark, root, "bronze_events").collect())

    before = offsets()
    assert len(folders()) == 8
    # s-3 is not in Silver yet, and the second day is still open
    assert compact_bronze(spark, root, hour(6).date().replace(day=2)) == 3
    assert offsets() == before and len(folders()) == 6
    assert sum("batch_id=merged-" in f for f in folders()) == 1
    assert set(increments.increment(spark, root)) >= {"silver_electricity"}
    assert increments.increment(spark, root) == {}
    assert compact_bronze(spark, root, hour(6).date()) == 6
    assert offsets() == before and len(folders()) == 2
    assert compact_bronze(spark, root, hour(6).date()) == 0 and increments.increment(spark, root) == {}
    # a merged batch is delivered once more, a merge broke off before its commit: neither is seen
    batch(spark, root, "s-1", old)
    batch(spark, root, "merged-lost", old)
    assert offsets() == before


# Landed runs, offset ranges -----------------------------------------------------------------


def test_only_runs_with_a_manifest_are_read(spark, tmp_path):
    root, options = str(tmp_path), dict(source="eia", dataset="d", ingested_at="2026-08-10T00:00:00Z")
    records = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert landed.land_snapshot(records, root, run_id="one", **options) == 2
    folder = f"{root}/ingestion_date=2026-08-10"
    landed.stage_records(records, f"{folder}/run_id=broken")
    landed.stage_records(records, f"{folder}/run_id=one")
    with pytest.raises(ValueError):
        landed.land_snapshot(records.limit(0), root, run_id="none", **options)
    with pytest.raises(ValueError):
        landed.land_snapshot(records, root, run_id="few", query_state="oh", total_results=1, **options)
    assert commits.listed(spark, f"{folder}/run_id=none") == commits.listed(spark, f"{folder}/run_id=few") == []
    assert landed.land_snapshot(records, root, run_id="state", query_state="oh", total_results=7, **options) == 2
    snapshots, rows = landed.read_landed_runs(spark, root)
    found = {r.snapshot: json.loads(r.metadata) for r in snapshots.collect()}
    assert set(found) == {"one", "state"} and found["one"]["record_count"] == 2
    assert (found["state"]["query_state"], found["state"]["total_results"]) == ("OH", 7)
    assert {r.has_records for r in snapshots.collect()} == {True}
    texts = sorted((r.snapshot, r.record) for r in rows.collect())
    assert len(texts) == 4 and texts[0] == ("one", '{"a":1,"b":null}')


def test_second_writer_of_a_run_fails(spark, tmp_path, monkeypatch):
    root, options = str(tmp_path), dict(source="eia", dataset="d", ingested_at="2026-08-10T00:00:00Z")
    records = spark.createDataFrame([(1,)], "a int")
    landed.land_snapshot(records, root, run_id="one", **options)
    monkeypatch.setattr(landed, "read_published", lambda *_: None)  # both looked before one wrote
    with pytest.raises(FileExistsError):
        landed.land_snapshot(records.limit(1), root, run_id="one", **options)
    names = commits.listed(spark, f"{root}/ingestion_date=2026-08-10/run_id=one")
    assert len(names) == 2 and names[0] == "manifest.json"


def test_ranges_read_no_payload(spark, tmp_path):
    rows = [("t", p, o, hour(6), b"k", b"v") for p, offsets in ((0, (3, 4, 7)), (1, (0,))) for o in offsets]
    spark.createDataFrame(rows, RECORD).write.parquet(f"{tmp_path}/topic")
    records = bus.folder_batch(spark, f"{tmp_path}/topic")
    ranges = bus.offset_ranges(records)
    found = sorted(tuple(r) for r in ranges.collect())
    assert found == [("t", 0, 3, 8, 3, 5), ("t", 1, 0, 1, 1, 1)]
    plan = ranges._jdf.queryExecution().executedPlan().toString()
    assert "value" not in plan and "timestamp" not in plan
    limits = ranges.withColumn("end_offset", F.lit(7))
    assert sorted(r.offset for r in bus.within(records, limits).collect()) == [0, 3, 4]
    assert bus.offset_ranges(records.limit(0)).count() == 0


# The log of outcomes -----------------------------------------------------------------------


def message(offset, text):
    return ("t", 0, offset, hour(6), b"k", text.encode())


def good(offset):
    return message(
        offset,
        json.dumps(
            {
                "event_id": f"e{offset}", "event_version": "1.0", "source": "eia", "dataset": "d",
                "event_type": "x", "partition_key": "k", "emitted_at": "2026-08-10T06:00:00Z",
                "replay": False, "payload": {"a": 1},
            }
        ),
    )


def test_every_attempt_counts_once(spark, tmp_path):
    log = OutcomeLog(spark, f"{tmp_path}/log")
    parsed = parse_envelopes(spark.createDataFrame([good(0), good(1), message(2, "x")], RECORD))
    trouble = [HandlerFailed(parsed.where("offset = 1")), RuntimeError("all"), None]

    def handler(valid):
        if problem := trouble.pop(0):
            raise problem

    process = bronze_batch(f"{tmp_path}/tables", "n", "s", handler, log)

    def totals():
        start_totals(log, f"{tmp_path}/totals", f"{tmp_path}/progress").awaitTermination()
        found = read_totals(spark, f"{tmp_path}/totals").collect()
        return {(r.source, r.outcome): r.messages for r in found}

    for _ in range(2):
        with pytest.raises((HandlerFailed, RuntimeError)):
            process(parsed, 0)
    assert totals() == {("eia", "handler_failed"): 1 + 2}
    process(parsed, 0)
    trouble.append(None)
    process(parsed, 0)  # delivered again after its end, as after a crash before the commit
    done = {("eia", "handler_failed"): 3, ("eia", "processed"): 2, ("unknown", "dead_lettered"): 1}
    assert totals() == done
    assert totals() == done  # restarted without new entries
    rates = read_totals(spark, f"{tmp_path}/totals").where("outcome = 'processed'").first()
    assert rates.messages_per_second == 2 / 60 and rates.window_start == hour(6)
