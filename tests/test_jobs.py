import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from amperline.plans import bridges, medallion, serving
from amperline.sources import bus
from amperline.sources.schemas import RECORD
from amperline.sources.tables import export_tables, read_layer, write_layer
from amperline.streaming.bronze import rows_processed, start_append, start_bronze
from amperline.streaming.outcomes import outcome_rate
from amperline.operators.envelope import parse_envelopes

SF = "/root/testdata/sf0.001"


def message(offset, value, minute=0):
    return ("t", 0, offset, datetime(2026, 8, 10, 6, minute), b"PJM", value.encode())


def envelope(source, payload, offset):
    return json.dumps(
        {
            "event_id": f"e{offset}", "event_version": "1.0", "source": source, "dataset": "d",
            "event_type": "t", "partition_key": "k", "emitted_at": "2026-08-10T06:00:00Z",
            "replay": False, "source_timestamp": None, "payload": payload,
        }
    )


def put(spark, folder, *rows):
    spark.createDataFrame(list(rows), RECORD).coalesce(1).write.mode("append").parquet(folder)


def drain(spark, tmp_path, **options):
    query = start_bronze(
        bus.folder_stream(spark, f"{tmp_path}/topic"),
        f"{tmp_path}/tables",
        f"{tmp_path}/progress",
        **options,
    )
    query.awaitTermination()
    return query


def test_stream_drains_carries_on_and_counts(spark, tmp_path):
    root = f"{tmp_path}/tables"
    put(spark, f"{tmp_path}/topic", message(0, envelope("eia", {"a": 1}, 0)), message(1, "{bad"))
    assert rows_processed(drain(spark, tmp_path)) == 2
    assert rows_processed(drain(spark, tmp_path)) == 0
    put(spark, f"{tmp_path}/topic", message(2, envelope("nws", {"a": 2}, 2)))
    assert rows_processed(drain(spark, tmp_path)) == 1
    bronze = read_layer(spark, root, "bronze_events")
    assert sorted((r.offset, r.source) for r in bronze.collect()) == [(0, "eia"), (2, "nws")]
    rejected = read_layer(spark, root, "bronze_quarantine").collect()
    assert [(r.event_json, r.validation_error) for r in rejected] == [
        ("{bad", "missing_or_invalid_event_id")
    ]
    letters = spark.read.parquet(f"{root}/dead_letters").collect()
    assert len(letters) == 1 and json.loads(bytes(letters[0].value))["source"] == "platform"


def test_failing_handler_leaves_the_batch_uncommitted(spark, tmp_path):
    put(spark, f"{tmp_path}/topic", message(0, envelope("eia", {"a": 1}, 0)))

    def broken(valid):
        raise RuntimeError("handler failed")

    with pytest.raises(Exception, match="handler failed"):
        drain(spark, tmp_path, handler=broken)
    seen = []
    drain(spark, tmp_path, handler=lambda valid: seen.append(valid.count()))
    assert seen == [1]
    assert read_layer(spark, f"{tmp_path}/tables", "bronze_events").count() == 1


def test_repeated_batch_replaces_its_own_rows(spark, tmp_path):
    from amperline.streaming.bronze import bronze_batch

    batch = parse_envelopes(
        spark.createDataFrame([message(0, envelope("eia", {"a": 1}, 0)), message(1, "x")], RECORD)
    )
    process = bronze_batch(str(tmp_path), "demo", "one")
    for batch_id in (4, 4, 5):
        process(batch, batch_id)
    assert read_layer(spark, str(tmp_path), "bronze_events").count() == 2
    assert read_layer(spark, str(tmp_path), "bronze_quarantine").count() == 2


def test_writes_of_a_batch_read_it_in_bounded_parts(spark, tmp_path):
    from amperline.streaming.bronze import bronze_batch

    # a batch that reaches the function in one task, as the source deals a large one to few
    rows = [message(i, envelope("eia", {"a": i}, i) if i % 4 else "x") for i in range(3000)]
    batch = parse_envelopes(spark.createDataFrame(rows, RECORD).coalesce(1))
    sizes = []

    def handler(valid):
        sizes.extend(valid.rdd.glom().map(len).collect())

    settings = {"spark.sql.files.maxPartitionBytes": "16k", "parquet.block.size": "16384"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        bronze_batch(str(tmp_path), "demo", "one", handler)(batch, 0)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert sum(sizes) == 2250 and max(sizes) < 2250 / 2
    assert read_layer(spark, str(tmp_path), "bronze_events").count() == 2250
    assert read_layer(spark, str(tmp_path), "bronze_quarantine").count() == 750


def test_streams_with_their_own_checkpoints_keep_each_others_rows(spark, tmp_path):
    for part in (0, 1):
        topic = f"{tmp_path}/topic-{part}"
        put(spark, topic, message(2 * part, envelope("eia", {"a": part}, part)), message(2 * part + 1, "x"))
        for _ in range(2):
            records = bus.folder_stream(spark, topic)
            start_bronze(records, f"{tmp_path}/tables", f"{tmp_path}/progress-{part}").awaitTermination()
    for name in ("bronze_events", "bronze_quarantine"):
        assert read_layer(spark, f"{tmp_path}/tables", name).count() == 2
    assert spark.read.parquet(f"{tmp_path}/tables/dead_letters").count() == 2


def test_windowed_outcomes_on_a_stream(spark, tmp_path):
    rows = [message(i, envelope("eia", {"a": 1}, i), minute=i) for i in (0, 0, 1, 30)]
    put(spark, f"{tmp_path}/topic", *rows)
    rates = outcome_rate(parse_envelopes(bus.folder_stream(spark, f"{tmp_path}/topic")))
    query = start_append(rates, f"{tmp_path}/rates", f"{tmp_path}/progress")
    query.awaitTermination()
    found = spark.read.schema(rates.schema).parquet(f"{tmp_path}/rates").collect()
    assert sorted((r.window_start.minute, r.messages) for r in found) == [(0, 2), (1, 1)]


def test_bounded_read_and_peek(spark, tmp_path):
    put(spark, f"{tmp_path}/topic", *[message(i, "x") for i in range(9)])
    assert bus.peek(bus.folder_batch(spark, f"{tmp_path}/topic")).count() == 5


def test_all_layers_from_topic_to_served_marts(spark, tmp_path):
    root = f"{tmp_path}/lake"
    bridges.raw_topic(spark, SF).write.parquet(f"{tmp_path}/topic")
    start_bronze(
        bus.folder_stream(spark, f"{tmp_path}/topic"), root, f"{tmp_path}/progress"
    ).awaitTermination()
    for offset, rows in enumerate((bridges.weather_bronze(spark, SF), bridges.station_bronze(spark, SF))):
        dated = rows.withColumns(
            {
                "kafka_date": F.to_date("kafka_timestamp"),
                "batch_id": F.lit(str(100 + offset)),
                "event_json": F.lit(None).cast("string"),
            }
        )
        write_layer(
            dated.withColumn("kafka_date", F.lit("2026-01-01").cast("date")),
            root,
            "bronze_events",
            only_touched=True,
        )
    silver = medallion.build_silver(spark, root)
    gold = medallion.build_gold(spark, root)
    assert silver["silver_electricity"] == read_layer(spark, root, "silver_electricity").count()
    assert min(silver.values()) > 0 and min(gold.values()) > 0
    assert medallion.build_silver(spark, root) == silver
    tables = medallion.build_marts(spark, root)
    assert set(tables) == set(medallion.MARTS)
    assert spark.table("mart_grid_hourly").count() == gold["gold_hourly"]
    snapshot = medallion.stored_quality(spark, root).first()
    assert snapshot.conservation_state == "BALANCED"
    assert snapshot.failure_rows == silver["silver_quarantine"]
    assert serving.authorities(tables["mart_balancing_authority_performance"]).count() == 8
    assert serving.weather(tables["mart_weather_forecast"], 168).count() == 168
    cities = serving.cities(tables["mart_ev_city_rankings"], "as").collect()
    assert cities and {r.state for r in cities} == {"AS"}
    exported = {
        r.relation: r.rows for r in export_tables(tables, f"{tmp_path}/export").collect()
    }
    assert exported["mart_grid_hourly"] == gold["gold_hourly"]


def test_missing_and_empty_layers(spark, tmp_path):
    assert read_layer(spark, str(tmp_path), "silver_quarantine") is None
    assert medallion.stored_quality(spark, str(tmp_path)).first().conservation_state == "UNKNOWN"
    empty = spark.createDataFrame(
        [], "event_id string, event_type string, topic string, partition int, offset bigint, "
        "kafka_timestamp timestamp, quality_error string, source string"
    )
    write_layer(empty, str(tmp_path), "silver_quarantine")
    assert read_layer(spark, str(tmp_path), "silver_quarantine").count() == 0


def test_serving_bounds(spark):
    frame = spark.range(1)
    with pytest.raises(ValueError):
        serving.timeline(frame, 23)
    with pytest.raises(ValueError):
        serving.cities(frame, "OHIO")
    with pytest.raises(ValueError):
        serving.recent_runs(frame, 201)


def test_landed_documents_cut_slots_into_bounded_documents(spark, monkeypatch):
    from pyspark.sql import Window

    from amperline.plans import job_queries
    from amperline.session import shared_folder

    monkeypatch.setattr(job_queries, "DOCUMENT_SPAN", 37, raising=False)
    got = job_queries.landed_documents(spark, SF).collect()
    records = bridges.landed_snapshots(spark, SF)[1]
    in_slot = Window.partitionBy("slot").orderBy("position")
    slotted = records.withColumn("slot", F.split_part("snapshot", F.lit("-"), F.lit(2)))
    expected = slotted.select(
        "slot",
        (F.row_number().over(in_slot) - 1).alias("position"),
        F.get_json_object("record", "$.respondent").alias("respondent"),
        F.get_json_object("record", "$.type").alias("record_type"),
    ).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))
    files = spark.read.text(f"{shared_folder(spark)}/table-*/documents/slot=*/start=*/*.txt")
    per_slot = files.select(F.regexp_extract(F.input_file_name(), r"slot=([^/]+)/", 1).alias("slot"))
    assert per_slot.groupBy("slot").count().where("count > 1").count() > 0


def test_topic_runs_are_cut_into_bounded_files(spark, monkeypatch):
    from amperline.plans import job_queries

    def compacted():
        return sorted(tuple(r) for r in job_queries.compacted_bronze(spark, SF).collect())

    whole = compacted()
    folders, streams, read = [], [], bus.folder_stream

    def folder_stream(spark, path, files_per_batch=1000):
        folders.append(path)
        return read(spark, path, files_per_batch)

    def started(*args, **kwargs):
        streams.append(start_bronze(*args, **kwargs))
        return streams[-1]

    monkeypatch.setattr(bridges, "TOPIC_FILE_ROWS", 40)
    monkeypatch.setattr(job_queries.bus, "folder_stream", folder_stream)
    monkeypatch.setattr(job_queries, "start_bronze", started)
    assert compacted() == whole
    per_file = bus.folder_batch(spark, folders[0]).groupBy(F.input_file_name()).count()
    assert per_file.count() > 6 and per_file.agg(F.max("count")).first()[0] <= 2 * 40
    batches = [p for p in streams[0].recentProgress if int(p["numInputRows"]) > 0]
    assert len(batches) == 6


def test_bronze_stream_topic_is_cut_into_bounded_files(spark, monkeypatch):
    from amperline.plans import catalog

    whole = sorted(tuple(r) for r in catalog.bronze_stream(spark, SF).collect())
    folders, read = [], bus.folder_stream

    def folder_stream(spark, path, files_per_batch=1000):
        folders.append(path)
        return read(spark, path, files_per_batch)

    monkeypatch.setattr(bridges, "TOPIC_FILE_ROWS", 40)
    monkeypatch.setattr(catalog.bus, "folder_stream", folder_stream)
    assert sorted(tuple(r) for r in catalog.bronze_stream(spark, SF).collect()) == whole
    per_file = bus.folder_batch(spark, folders[0]).groupBy(F.input_file_name()).count()
    assert per_file.count() > 4 and per_file.agg(F.max("count")).first()[0] <= 2 * 40


def test_dealt_rows_spread_over_more_tasks_as_the_table_grows(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range((least + 2) * bridges.DEALT_ROWS).withColumnRenamed("id", "event_id")
    spread = bridges.dealt(rows, "event_id")
    assert spread.rdd.getNumPartitions() == least + 2
    assert max(spread.rdd.glom().map(len).collect()) < 2 * bridges.DEALT_ROWS
    assert spread.count() == rows.count()
    assert bridges.dealt(spark.range(10), "id").rdd.getNumPartitions() == least
