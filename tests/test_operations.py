import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from amperline.operators import freshness, incidents, lineage, quality, runs, typed
from amperline.plans import serving
from amperline.sources import run_log

NOW = datetime(2026, 8, 13, 12)
SIGNAL = (
    "source string, display_name string, dataset string, latest_timestamp timestamp, "
    "timestamp_basis string, fresh_within_hours double, stale_after_hours double, state string, "
    "age_hours double"
)


def one_time(spark, column, moment):
    return spark.createDataFrame([(moment,)], f"{column} timestamp")


def signal(source, state, age):
    return (source, source.upper(), "d", NOW, "basis", 6.0, 24.0, state, age)


def test_freshness_states(spark):
    tables = {
        "mart_grid_hourly": one_time(spark, "period", NOW - timedelta(hours=6)),
        "mart_weather_forecast": one_time(spark, "kafka_timestamp", NOW - timedelta(hours=24.01)),
    }
    found = {r.source: r for r in freshness.source_freshness(spark, tables, NOW).collect()}
    assert (found["eia"].state, found["eia"].age_hours) == ("FRESH", 6.0)
    assert found["eia"].timestamp_basis == "Latest analytical period"
    assert (found["nws"].state, found["nws"].age_hours) == ("STALE", 24.01)
    assert found["afdc"].state == "UNKNOWN" and found["afdc"].age_hours is None
    assert found["afdc"].timestamp_basis == "No supported timestamp column"


def test_freshness_column_preference_future_and_empty(spark):
    both = one_time(spark, "period", NOW - timedelta(hours=90)).withColumn(
        "kafka_timestamp", F.lit("2026-08-13T03:00:00Z")
    )
    tables = {
        "mart_grid_hourly": both,
        "mart_weather_forecast": one_time(spark, "period_start", NOW + timedelta(hours=3)),
        "mart_ev_city_rankings": one_time(spark, "latest_station_update", NOW).limit(0),
    }
    found = {r.source: r for r in freshness.source_freshness(spark, tables, NOW).collect()}
    assert (found["eia"].state, found["eia"].age_hours) == ("DELAYED", 9.0)
    assert (found["nws"].state, found["nws"].age_hours) == ("FRESH", 0.0)
    assert found["afdc"].state == "UNKNOWN"
    assert found["afdc"].timestamp_basis == "Latest station update"


def log_line(run_id, status, started, finished=None, stage="build_gold", **extra):
    entry = dict(
        run_id=run_id, stage=stage, status=status, started_at=started.isoformat() + "+00:00",
        finished_at=finished and finished.isoformat() + "Z",
        duration_seconds=(finished - started).total_seconds() if finished else None,
        exit_code=None, records_processed=None, throughput_records_per_second=None,
        command=["x"],
    )
    return json.dumps({**entry, **extra})


def states(spark, tmp_path, *lines):
    path = tmp_path / "runs.jsonl"
    path.write_text("\n".join(lines) + "\n")
    return run_log.parse_run_log(run_log.read_log_lines(spark, str(path)))


def test_run_log_keeps_the_last_state_and_skips_bad_lines(spark, tmp_path):
    early, late = NOW - timedelta(hours=2), NOW - timedelta(hours=1)
    parsed = states(
        spark,
        tmp_path,
        log_line("a", "STARTED", early),
        "",
        "{broken",
        "[1, 2]",
        log_line("x", "STARTED", early, command=None),
        log_line("y", "STARTED", early, command=["ok", None]),
        log_line("b", "FAILED", late, late + timedelta(seconds=5)),
        log_line("a", "SUCCEEDED", early, early + timedelta(seconds=20), records_processed=47),
    )
    latest = runs.latest_runs(parsed).collect()
    assert [(r.run_id, r.status) for r in latest] == [("b", "FAILED"), ("a", "SUCCEEDED")]
    assert latest[1].throughput_records_per_second == 2.35
    assert latest[0].throughput_records_per_second is None
    assert serving.recent_runs(parsed, 1).count() == 1
    summary = runs.run_summary(runs.latest_runs(parsed)).first()
    assert (summary.total_runs, summary.failed_runs, summary.successful_runs) == (2, 1, 1)
    assert summary.last_success_at == early + timedelta(seconds=20)


def test_run_log_round_trip(spark, tmp_path):
    parsed = states(spark, tmp_path, log_line("a", "STARTED", NOW))
    target = str(tmp_path / "log")
    text = parsed.withColumns(
        {"started_at": F.date_format("started_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")}
    )
    run_log.append_run_log(text, target)
    run_log.append_run_log(text, target)
    again = run_log.parse_run_log(run_log.read_log_lines(spark, target))
    assert again.count() == 2 and runs.latest_runs(again).first().started_at == NOW


def test_later_states_win_in_files_of_any_size(spark, tmp_path):
    for long_end in (False, True):
        target = str(tmp_path / f"log-{long_end}")
        words = {False: ["run"], True: ["run", "x" * 500]}
        start = {"run_id": "a", "stage": "s", "status": "STARTED", "started_at": "2026-01-01T00:00:00Z"}
        end = {**start, "status": "SUCCEEDED", "finished_at": "2026-01-01T00:01:00Z"}
        for line, long in ((start, not long_end), (end, long_end)):
            text = json.dumps({**line, "command": words[long]})
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(target)
        found = runs.latest_runs(run_log.parse_run_log(run_log.read_log_lines(spark, target)))
        assert [r.status for r in found.collect()] == ["SUCCEEDED"]


def test_ill_typed_run_log_lines_are_dropped(spark):
    good = {"run_id": "a", "stage": "s", "status": "STARTED", "started_at": "2026-01-01T00:00:00Z"}
    lines = [
        {**good, "command": ['quoted "]', "b"]},
        {**good, "run_id": 7, "command": ["b"]},
        {**good, "command": [1, 2]},
        {**good, "command": ["b", None]},
        {**good, "command": "b"},
    ]
    rows = [(i, json.dumps(line)) for i, line in enumerate(lines)]
    frame = spark.createDataFrame(rows, "line_no long, line string")
    assert [r.line_no for r in run_log.parse_run_log(frame).collect()] == [0]


def test_record_marker(spark):
    lines = spark.createDataFrame([("RECORDS_PROCESSED=42 done",), ("nothing",)], "line string")
    assert [r[0] for r in lines.select(runs.records_from_marker(F.col("line"))).collect()] == [
        42,
        None,
    ]


def sla_of(spark, tmp_path, *lines):
    parsed = states(spark, tmp_path, *lines) if lines else states(spark, tmp_path, "")
    found = runs.stage_sla(runs.latest_runs(parsed), NOW).collect()
    assert len(found) == 4
    return next(r for r in found if r.stage == "build_gold")


def ago(**delta):
    return NOW - timedelta(**delta)


def test_sla_states(spark, tmp_path):
    assert sla_of(spark, tmp_path).status == "NO_RUN_DATA"
    assert sla_of(spark, tmp_path, log_line("a", "STARTED", ago(seconds=30))).status == "RUNNING"
    stalled = sla_of(spark, tmp_path, log_line("a", "STARTED", ago(seconds=601)))
    assert (stalled.status, stalled.current_runtime_seconds) == ("STALLED", 601.0)
    assert stalled.runtime_threshold_basis == "configured_fallback"
    done = ago(minutes=5)
    failed = sla_of(spark, tmp_path, log_line("a", "FAILED", ago(minutes=6), done))
    assert (failed.status, failed.recent_failures) == ("FAILED", 1)
    good = sla_of(spark, tmp_path, log_line("a", "SUCCEEDED", ago(minutes=6), done))
    assert (good.status, good.success_age_hours) == ("SUCCEEDED", 0.083)
    old = log_line("a", "SUCCEEDED", ago(hours=26), ago(hours=25))
    assert sla_of(spark, tmp_path, old).status == "OVERDUE"
    assert sla_of(spark, tmp_path, log_line("a", "PAUSED", ago(hours=1))).status == "UNKNOWN"


@pytest.mark.parametrize(
    ("durations", "limit"), [((100, 150, 200), 600.0), ((1, 2, 3), 60.0), ((2000,) * 4, 3600.0)]
)
def test_learned_limit(spark, tmp_path, durations, limit):
    lines = [
        log_line(f"r{i}", "SUCCEEDED", ago(hours=5 + i), ago(hours=5 + i) + timedelta(seconds=d))
        for i, d in enumerate(durations)
    ]
    found = sla_of(spark, tmp_path, *lines)
    assert found.expected_max_runtime_seconds == limit
    assert found.runtime_threshold_basis == "observed_median_x4"


def components(spark, *rows):
    return spark.createDataFrame(
        list(rows), "name string, status string, detail string, latency_ms double"
    )


def test_incidents(spark):
    signals = spark.createDataFrame(
        [signal("eia", "FRESH", 1.0), signal("nws", "STALE", 30.0), signal("afdc", "DELAYED", 50.0)],
        SIGNAL,
    )
    parts = components(
        spark,
        ("kafka", " Unhealthy ", "down.", 12.34),
        ("kafka_consumer", "degraded", "slow.", 1.0),
        ("warehouse", "healthy", "fine.", 1.0),
        ("prometheus", "paused", "odd.", 0.0),
    )
    found = incidents.operational_incidents(signals, parts).collect()
    assert [(r.incident_id, r.severity) for r in found] == [
        ("component:kafka:unhealthy", "CRITICAL"),
        ("component:kafka_consumer:degraded", "HIGH"),
        ("source:nws:stale", "HIGH"),
        ("component:prometheus:paused", "ELEVATED"),
        ("source:afdc:delayed", "ELEVATED"),
    ]
    assert found[1].title == "Kafka Consumer is degraded"
    assert found[0].evidence == "down. Observed latency: 12.3 ms."
    assert found[2].evidence.startswith("Latest signal is 30.0h old.")
    health = incidents.component_health(parts).first()
    assert tuple(health) == (1, 4, "unhealthy")
    top = incidents.highest_severity(incidents.operational_incidents(signals, parts))
    assert top.first()[0] == "CRITICAL"


def test_nothing_wrong_and_unknown_source(spark):
    fine = spark.createDataFrame([signal("eia", "FRESH", 1.0)], SIGNAL)
    healthy = components(spark, ("kafka", "healthy", "", 1.0))
    none = incidents.operational_incidents(fine, healthy)
    assert none.count() == 0 and incidents.highest_severity(none).first()[0] == "NORMAL"
    unknown = spark.createDataFrame([signal("eia", "UNKNOWN", None)], SIGNAL)
    row = incidents.operational_incidents(unknown, healthy).first()
    assert (row.incident_id, row.current_state) == ("source:eia:unknown", "UNKNOWN")


def test_lineage(spark, tmp_path):
    signals = spark.createDataFrame(
        [signal("eia", "FRESH", 1.0), signal("nws", "STALE", 30.0)], SIGNAL
    )
    parts = components(spark, ("kafka", "healthy", "up.", 1.0), ("warehouse", "degraded", "w.", 1.0))
    logged = states(
        spark,
        tmp_path,
        log_line("a", "SUCCEEDED", ago(hours=2), ago(hours=1), stage="kafka_to_bronze"),
        log_line("b", "FAILED", ago(hours=2), ago(hours=1), stage="bronze_to_silver"),
        log_line("c", "FAILED", ago(hours=9), ago(hours=8), stage="dbt_build"),
        log_line("d", "STARTED", ago(minutes=50), stage="dbt_build"),
    )
    nodes = lineage.lineage_nodes(
        signals,
        parts,
        incidents.operational_incidents(signals, parts),
        runs.latest_runs(logged),
        NOW,
    )
    found = {r.node_id: r for r in nodes.collect()}
    assert {n: r.state for n, r in found.items()} == {
        "source-eia": "HEALTHY",
        "source-nws": "UNHEALTHY",
        "source-afdc": "UNKNOWN",
        "kafka": "HEALTHY",
        "spark-bronze": "HEALTHY",
        "spark-silver": "UNHEALTHY",
        "spark-gold": "UNKNOWN",
        "dbt": "UNHEALTHY",
        "duckdb": "DEGRADED",
        "fastapi": "DEGRADED",
        "nextjs": "DEGRADED",
    }
    assert found["dbt"].operational_status == "STALLED" and found["dbt"].recent_runs == 2
    assert "Active incident: NWS source is stale." in found["source-nws"].detail
    assert lineage.worst_state(nodes).first()[0] == "UNHEALTHY"
    edges = {r.edge_id: r for r in lineage.lineage_edges(nodes).collect()}
    assert len(edges) == 10
    assert (edges["bronze-silver"].source_state, edges["bronze-silver"].target_state) == (
        "HEALTHY",
        "UNHEALTHY",
    )
    assert lineage.lineage_counts(nodes).first().instrumented == 3


@pytest.mark.parametrize(
    ("counts", "state", "removed", "deduplicated", "retention"),
    [
        ((47129, 47109, 7), "BALANCED", 20, 13, 99.958),
        ((100, 90, 15), "CHECK", 10, None, 90.0),
        ((90, 100, 0), "CHECK", -10, None, 111.111),
        ((100, 95, None), "PARTIAL", 5, None, 95.0),
        ((None, 95, 2), "UNKNOWN", None, None, None),
        ((0, 0, 0), "BALANCED", 0, 0, None),
    ],
)
def test_conservation(spark, counts, state, removed, deduplicated, retention):
    frame = spark.createDataFrame(
        [counts], "bronze_rows bigint, silver_rows bigint, failure_rows bigint"
    )
    row = quality.conservation(frame).first()
    assert (row.conservation_state, row.removed_before_silver) == (state, removed)
    assert (row.deduplicated_rows, row.silver_retention_pct) == (deduplicated, retention)


def test_missing_layers_stay_unknown(spark):
    counts = quality.layer_counts(
        spark,
        [
            ("BRONZE", "All", spark.range(5)),
            ("SILVER", "A", spark.range(4)),
            ("SILVER", "B", None),
            ("GOLD", "A", None),
            ("QUARANTINE", "All", None),
        ],
    )
    row = quality.quality_snapshot(counts).first()
    assert (row.bronze_rows, row.silver_rows, row.gold_rows) == (5, 4, None)
    assert (row.conservation_state, row.status) == ("PARTIAL", "MEASURED")


def test_model_tests_find_violations(spark):
    frame = spark.createDataFrame([("a", "low"), ("a", "odd"), (None, None)], "k string, b string")
    first = quality.ModelTests("m", ("k",), "k", (("b", ("low", "high")),))
    second = quality.ModelTests("n", ("b",))

    def found(*declared):
        return {(r.model, r.test): r.failures for r in quality.generic_tests(frame, *declared).collect()}

    both = {("m", "not_null:k"): 1, ("m", "accepted_values:b"): 1, ("m", "unique:k"): 1, ("n", "not_null:b"): 1}
    assert found(first, second) == both
    assert found(second) == {("n", "not_null:b"): 1}
    frame = frame.limit(0)
    assert found(first, second) == dict.fromkeys(both, 0) and found(second) == {("n", "not_null:b"): 0}
    with pytest.raises(ValueError):
        found(first, first)


@pytest.mark.parametrize("grain", [None, ("city",)])
def test_counts_of_a_source_equal_its_layers(spark, grain):
    rows = [
        (True, 1, "a", 1), (True, 1, "b", 2), (True, 2, "b", 1), (True, 3, "c", 1),
        (False, 1, "a", 9), (False, None, None, 1), (False, None, None, 2),
    ]
    frame = spark.createDataFrame(
        [(v, k, c, datetime(2026, 1, o), 0, o) for v, k, c, o in rows],
        "is_valid boolean, station_id long, city string, updated_at timestamp, partition int, offset long",
    ).withColumns({n: F.col("updated_at") for n in ("event_emitted_at", "kafka_timestamp")})
    counted = quality.source_counts(frame, typed.STATIONS, grain).first()
    silver = typed.latest_valid(frame, typed.STATIONS)
    gold = silver.select(*(grain or ("station_id",))).distinct().count()
    assert tuple(counted) == (7, silver.count(), gold, 3) == (7, 3, 2 if grain else 3, 3)
    assert tuple(quality.source_counts(frame.limit(0), typed.STATIONS, grain).first()) == (0, 0, 0, 0)
