"""Registered queries that run jobs: they write layers, topics or control tables and read them back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from pyspark.errors import StreamingQueryException

from amperline.functions.clock import instant
from amperline.operators import contracts, coverage, gold, marts, publish
from amperline.operators.envelope import parse_envelopes, valid_envelopes
from amperline.plans import bridges as b
from amperline.plans import increments
from amperline.plans.catalog import (
    ENVELOPE_OUTPUT,
    METRIC_OUTPUT,
    STATION_OUTPUT,
    _received,
    _watermarks,
    query,
    rounded,
)
from amperline.plans.compaction import compact_bronze
from amperline.session import durable, scratch_folder
from amperline.sources import bus, landed
from amperline.sources.control import ControlTable
from amperline.sources.tables import export_tables, layer_columns, read_layer, write_layer
from amperline.streaming.bronze import rows_processed, start_bronze
from amperline.streaming.outcomes import HandlerFailed, OutcomeLog, read_totals, start_totals


@query
def control_watermark(spark, sf):
    """Two windows in a row from a stored control table; the second starts where the first ended."""
    table = ControlTable(spark, scratch_folder(spark), "respondent STRING, watermark TIMESTAMP")
    silver = _received(spark, sf)
    table.commit(_watermarks(silver), 0)
    runs = [
        coverage.advance_control(
            table, ["respondent"], silver, b.NOW, "2024-01-05T00:00:00", max_window_hours=2
        ).withColumn("run", F.lit(run))
        for run in (1, 2)
    ]
    return runs[0].unionByName(runs[1])


def _bronze_batch(spark, root, rows, batch, late):
    """Write Bronze rows as a batch of that name: the late ones or the others."""
    dated = rows.where(late if batch == "late" else ~late).withColumns(
        {
            "kafka_date": F.to_date("kafka_timestamp"),
            "batch_id": F.lit(batch),
            "event_json": F.lit(None).cast("string"),
        }
    )
    write_layer(dated, root, "bronze_events", only_touched=True)


def _incremented(spark, rows, late):
    """A lake built from a first batch and brought up to date with the late one."""
    root = f"{scratch_folder(spark)}/lake"
    rows = durable(rows)
    _bronze_batch(spark, root, rows, "first", late)
    increments.rebuild(spark, root)
    _bronze_batch(spark, root, rows, "late", late)
    increments.increment(spark, root)
    return root


@query
def incremental_gold_hourly(spark, sf):
    """Gold after an increment of the last days and of late corrections to an earlier one."""
    day = F.to_date("kafka_timestamp")
    late = (day >= F.lit("2024-01-26").cast("date")) | (
        (day == F.lit("2024-01-10").cast("date")) & (F.col("offset") % 3 == 0)
    )
    root = _incremented(spark, b.electricity_bronze(spark, sf), late)
    return rounded(read_layer(spark, root, "gold_hourly"), "demand_forecast_error_pct")


@query
def incremental_stations(spark, sf):
    """Silver stations after an increment that brings the second report of every fourth station."""
    root = _incremented(spark, b.station_bronze(spark, sf), F.col("replay"))
    return read_layer(spark, root, "silver_stations").select(*STATION_OUTPUT, "offset")


@query
def landed_round_trip(spark, sf):
    """Verdicts on two landed runs, read back beside a third one that broke off before its manifest."""
    root = f"{scratch_folder(spark)}/landed"
    records = b.metric_events(spark, sf).select(
        "event_id",
        b.iso("period", "yyyy-MM-dd'T'HH").alias("period"),
        "respondent",
        F.concat(F.lit("Respondent "), "respondent").alias("respondent-name"),
        F.col("record_type").alias("type"),
        F.col("event_type").alias("type-name"),
        F.col("value").cast("string").alias("value"),
        F.lit("megawatthours").alias("value-units"),
    )
    for run in (0, 1):
        landed.land_snapshot(
            records.where(F.col("event_id") % 3 == run).drop("event_id"),
            root,
            source="eia",
            dataset="electricity/rto/region-data",
            run_id=f"run-{run}",
            ingested_at=b.NOW,
        )
    broken_off = f"{root}/ingestion_date={b.NOW[:10]}/run_id=run-2"
    landed.stage_records(records.where(F.col("event_id") % 3 == 2).drop("event_id"), broken_off)
    snapshots, rows = landed.read_landed_runs(spark, root)
    return contracts.validate_snapshots(snapshots, rows, contracts.ELECTRICITY_CONTRACT).withColumn(
        "declared_records", F.col("record_count")
    )



@query
def topic_ranges(spark, sf):
    """Offset ranges of a stored topic, and the records that a bounded read of their first halves gives."""
    folder = f"{scratch_folder(spark)}/topic"
    b.raw_topic(spark, sf).write.parquet(folder)
    records = bus.folder_batch(spark, folder)
    ranges = durable(bus.offset_ranges(records))
    halves = ranges.withColumn("end_offset", F.col("start_offset") + F.floor(F.col("span") / 2))
    read = bus.within(records, halves).groupBy("topic", "partition").agg(F.count("*").alias("first_half"))
    return ranges.join(read, ["topic", "partition"], "left")


@query
def outcome_stream(spark, sf):
    """Outcomes summed on a stream while another one drains a topic with a handler that fails once a batch."""
    folder = scratch_folder(spark)
    per_run = b.topic_files(spark, sf, f"{folder}/topic", 4)
    log, calls = OutcomeLog(spark, f"{folder}/outcomes"), []

    def handler(valid):
        calls.append(1)
        if len(calls) % 2:
            raise HandlerFailed(valid.where(F.col("offset") % 17 == 3))

    ended = False
    while not ended:
        stream = start_bronze(
            bus.folder_stream(spark, f"{folder}/topic", files_per_batch=2 * per_run),
            f"{folder}/tables",
            f"{folder}/progress",
            namespace=b.NAMESPACE,
            handler=handler,
            outcomes=log,
        )
        try:
            stream.awaitTermination()
            ended = True
        except StreamingQueryException:
            if not calls or len(calls) > 20:
                raise
        # a month of messages is replayed at once, so a minute may be that late
        start_totals(log, f"{folder}/totals", f"{folder}/summed", "60 days").awaitTermination()
    return rounded(read_totals(spark, f"{folder}/totals"), "messages_per_second")


@query
def contract_verdicts_weather(spark, sf):
    """Verdicts on daily forecast snapshots; keys of places are compared by value."""
    snapshots, records = b.weather_snapshots(spark, sf)
    return contracts.validate_snapshots(snapshots, records, contracts.WEATHER_CONTRACT)


@query
def contract_verdicts_stations(spark, sf):
    """Verdicts on station snapshots, their totals and their state."""
    snapshots, records = b.station_snapshots(spark, sf)
    return contracts.validate_snapshots(snapshots, records, contracts.STATION_CONTRACT)


def _published(snapshots, records, contract, event_id, *extracts):
    """Records of accepted snapshots normalised, enveloped, serialised and parsed back from the bus."""
    accepted, _ = contracts.gate(snapshots, records, contract)
    normal = NORMALISED[contract.source](accepted)
    ready = publish.envelopes(normal, contract.source, b.NOW, event_id=event_id)
    dataset_topic = f"{b.NAMESPACE}.{contract.name}.v1"
    messages = publish.bus_messages(ready, dataset_topic).select(
        "*",
        F.lit(0).alias("partition"),
        F.lit(0).cast("long").alias("offset"),
        instant(b.NOW).alias("timestamp"),
    )
    return valid_envelopes(parse_envelopes(messages)).select(
        "topic",
        "kafka_key",
        "event_id",
        "source",
        "dataset",
        "event_type",
        "partition_key",
        "replay",
        "source_timestamp",
        *[
            F.get_json_object("payload_json", f"$.{name}").cast(kind).alias(name)
            for name, kind in extracts
        ],
    )


NORMALISED = {
    "eia": contracts.normalised_electricity,
    "nws": contracts.normalised_weather,
    "afdc": contracts.normalised_stations,
}


@query
def published_envelopes(spark, sf):
    """Electricity records of the snapshots that pass their contract, as messages."""
    snapshots, records = b.landed_snapshots(spark, sf)
    event_id = F.concat_ws("-", F.lit("pub"), "respondent", "record_type")
    extracts = (("value", "double"), ("value_units", "string"))
    return _published(snapshots, records, contracts.ELECTRICITY_CONTRACT, event_id, *extracts)


@query
def published_forecasts(spark, sf):
    """Forecast records of the snapshots that pass their contract, as messages keyed by place."""
    snapshots, records = b.weather_snapshots(spark, sf)
    event_id = F.concat_ws("-", F.lit("pub"), gold.location_key(), publish.iso(F.col("period_start")))
    extracts = (("temperature", "double"), ("short_forecast", "string"))
    return _published(snapshots, records, contracts.WEATHER_CONTRACT, event_id, *extracts)


@query
def published_stations(spark, sf):
    """Station records of the snapshots that pass their contract, as messages keyed by state."""
    snapshots, records = b.station_snapshots(spark, sf)
    event_id = F.concat_ws("-", F.lit("pub"), "station_id")
    extracts = (("station_id", "long"), ("ev_network", "string"))
    return _published(snapshots, records, contracts.STATION_CONTRACT, event_id, *extracts)


@query
def compacted_bronze(spark, sf):
    """Bronze of a topic drained in six batches, after the merge of all but the last days."""
    folder = scratch_folder(spark)
    per_run = b.topic_files(spark, sf, f"{folder}/topic", 6)
    start_bronze(
        bus.folder_stream(spark, f"{folder}/topic", files_per_batch=per_run),
        f"{folder}/tables",
        f"{folder}/progress",
        namespace=b.NAMESPACE,
    ).awaitTermination()
    compact_bronze(spark, f"{folder}/tables", date(2024, 1, 26))
    return read_layer(spark, f"{folder}/tables", "bronze_events").select(*ENVELOPE_OUTPUT, "kafka_date")


def _drained(spark, sf, batches=1):
    """Folder of a lake whose Bronze tables were written by draining the raw topic, and the rows of two drains."""
    folder = scratch_folder(spark)
    per_run = b.topic_files(spark, sf, f"{folder}/topic", batches)
    processed = []
    for _ in range(2):
        stream = start_bronze(
            bus.folder_stream(spark, f"{folder}/topic", files_per_batch=per_run),
            f"{folder}/tables",
            f"{folder}/progress",
            namespace=b.NAMESPACE,
        )
        stream.awaitTermination()
        processed.append(rows_processed(stream))
    return folder, processed


@query
def quarantine_stream(spark, sf):
    """Messages that a drained stream put into quarantine, as they came."""
    folder, _ = _drained(spark, sf)
    rejected = read_layer(spark, f"{folder}/tables", "bronze_quarantine")
    return rejected.select(
        "topic", "partition", "offset", "kafka_timestamp", "kafka_key", "validation_error",
        (F.col("event_json") == "{invalid-json").alias("garbage"),
    )


@query
def stream_progress(spark, sf):
    """Rows that a stream reports for a drain and for a second one without new messages."""
    _, processed = _drained(spark, sf, batches=2)
    rows = [(run, count) for run, count in enumerate(processed, 1)]
    return spark.createDataFrame(rows, "run INT, rows_processed BIGINT")


@query
def rewritten_layer(spark, sf):
    """Silver written as a whole and then, for every third day, once more over itself."""
    root = f"{scratch_folder(spark)}/lake"
    silver = durable(b.electricity_silver(spark, sf).select(*layer_columns("silver_electricity")))
    write_layer(silver, root, "silver_electricity")
    again = silver.where(F.dayofmonth("period_date") % 3 == 0)
    write_layer(again, root, "silver_electricity", only_touched=True)
    return read_layer(spark, root, "silver_electricity").select(*METRIC_OUTPUT, "offset")


@query
def staged_views(spark, sf):
    """Gold found by a recursive glob, staged as a view and asked in SQL."""
    root = f"{scratch_folder(spark)}/lake"
    write_layer(b.hourly_gold(spark, sf), root, "gold_hourly")
    files = spark.read.option("basePath", f"{root}/gold_hourly").parquet(f"{root}/gold_hourly/*/")
    marts.staged_grid(files).createOrReplaceTempView("stg_hourly")
    return spark.sql(
        "SELECT period_date, hour_of_day, count(*) AS rows, sum(metric_count) AS metrics, "
        "count_if(contains_replay) AS replayed FROM stg_hourly GROUP BY period_date, hour_of_day"
    )


@query
def seeded_grid(spark, sf):
    """Hourly mart with respondent types from a seed file: one national respondent, two regions."""
    seed = f"{scratch_folder(spark)}/seed"
    codes = b.metric_events(spark, sf).select("respondent").distinct()
    kind = F.when(F.col("respondent") == "R0", "national").when(
        F.col("respondent").isin("R1", "R2"), "region"
    )
    codes.withColumns({"entity_type": kind, "entity_name": F.concat(F.lit("Area, "), "respondent")}).where(
        "entity_type IS NOT NULL"
    ).write.csv(seed, header=True)
    grid = marts.grid_hourly(b.hourly_gold(spark, sf), marts.respondent_types(spark, seed))
    return grid.groupBy("respondent", "entity_type").agg(
        F.count("*").alias("hours"), F.count("demand_mwh").alias("demand_hours")
    )


@query
def exported_marts(spark, sf):
    """Rows of the marts exported to one folder."""
    grid = durable(b.grid_mart(spark, sf))
    tables = {
        "mart_grid_hourly": grid,
        "mart_balancing_authority_performance": marts.authority_totals(grid),
        "mart_ev_city_rankings": b.city_gold(spark, sf),
        "mart_weather_forecast": b.weather_gold(spark, sf),
    }
    return export_tables(tables, f"{scratch_folder(spark)}/export")


# Event ids in the span of one landed document; a slot lands as many such documents.
DOCUMENT_SPAN = 100_000


@query
def landed_documents(spark, sf):
    """Snapshot documents, one file each, scanned and taken apart again.

    A slot's records land as documents of one span of event ids each, in
    ``slot=<slot>/start=<position of its first record in the slot>``, so no
    document, group or task holds a whole slot however large the input grows.
    """
    folder = f"{scratch_folder(spark)}/documents"
    _, records = b.landed_snapshots(spark, sf)
    slot = F.split_part("snapshot", F.lit("-"), F.lit(2))
    keyed = records.select(
        slot.alias("slot"), F.floor(F.col("position") / DOCUMENT_SPAN).alias("span"), "position", "record"
    )
    sizes = keyed.groupBy("slot", "span").agg(F.count("*").alias("found"))
    earlier = Window.partitionBy("slot").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("slot", "span", F.coalesce(F.sum("found").over(earlier), F.lit(0)).alias("start"))
    whole = keyed.groupBy("slot", "span").agg(
        F.sort_array(F.collect_list(F.struct("position", "record"))).getField("record").alias("records")
    )
    body = F.concat(
        F.lit('{"metadata":{"run_id":"'), "slot", F.lit('"},"records":['), F.array_join("records", ","), F.lit("]}")
    )
    named = whole.join(starts, ["slot", "span"]).select("slot", "start", body.alias("value"))
    named.repartition("slot", "start").write.partitionBy("slot", "start").text(folder)
    scanned = landed.read_snapshots(spark, folder)
    rows = landed.snapshot_records(scanned)
    start = F.regexp_extract("snapshot", r"/start=([0-9]+)/", 1).cast("long")
    return rows.select(
        F.regexp_extract("snapshot", r"slot=([^/]+)/", 1).alias("slot"),
        (start + F.col("position")).cast("int").alias("position"),
        F.get_json_object("record", "$.respondent").alias("respondent"),
        F.get_json_object("record", "$.type").alias("record_type"),
    )
