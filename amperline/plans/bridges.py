"""Project the given tables onto the shapes the operators work on.

Every bridge covers its whole tables. Defects (bad JSON, missing fields, wrong
units, ...) are spread by fixed remainders of the row's own id so that each rule
has rows that break it; the rest of the rows stay clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.operators import gold, marts, typed
from amperline.operators.envelope import parse_envelopes, valid_envelopes
from amperline.session import durable, use_utc
from amperline.sources.run_log import parse_run_log

NAMESPACE = "events"
ELECTRICITY_TOPIC = f"{NAMESPACE}.eia.region-data.v1"
NOW = "2024-01-31T12:00:00+00:00"
TYPE_OF_EVENT = {"purchase": "D", "view": "DF", "click": "NG", "signup": "TI", "error": "ERR"}
STAGES = ("kafka_to_bronze", "bronze_to_silver", "build_gold", "dbt_build")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf}/{name}.parquet")


#: Rows that one task of ``dealt`` renders and parses at most, beyond the configured partitions.
DEALT_ROWS = 100_000


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Narrow rows dealt to all tasks by their id, before envelopes are rendered and parsed from them.

    A given table may be one file of one row group, which one task reads. The number of
    partitions is given, so that adaptive execution does not merge them again; it is the
    configured one, or more for a larger table, so that a task's share does not grow with it.
    """
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, -(-rows.count() // DEALT_ROWS)), *keys)


def hits(column: str, divisor: int, remainder: int) -> Column:
    return F.col(column) % divisor == remainder


def iso(moment: str | Column, pattern: str = "yyyy-MM-dd'T'HH:mm:ss'Z'") -> Column:
    return F.date_format(moment, pattern)


def lookup(column: str, choices: dict[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(item) for pair in choices.items() for item in pair])
    return F.try_element_at(pairs, F.col(column))


# events -> bus records -> Bronze -> Silver -> Gold -> mart -------------------


def metric_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as electricity observations."""
    events = dealt(table(spark, sf, "events"), "event_id")
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("period"),
        F.concat(F.lit("R"), F.col("user_id") % 8).alias("respondent"),
        "user_id",
        lookup("event_type", TYPE_OF_EVENT).alias("record_type"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def raw_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Bus records with a JSON envelope, some of them defective."""
    events = metric_events(spark, sf)
    payload = F.struct(
        F.when(hits("event_id", 107, 9), F.lit("not-a-period"))
        .otherwise(iso("period", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("period"),
        "record_type",
        "respondent",
        F.concat(F.lit("Respondent "), "respondent").alias("respondent_name"),
        F.col("event_type").alias("type_name"),
        F.when(~hits("event_id", 101, 5), F.col("value")).alias("value"),
        F.when(hits("event_id", 103, 7), F.lit(" "))
        .otherwise(F.lit("megawatthours"))
        .alias("value_units"),
    )
    source = (
        F.when(hits("event_id", 61, 3), F.lit("unknown"))
        .when(hits("event_id", 79, 7), F.lit("platform"))
        .otherwise(F.lit("eia"))
    )
    envelope = F.struct(
        F.concat(F.lit("evt-"), "event_id").alias("event_id"),
        F.when(hits("event_id", 59, 2), F.lit("2.0")).otherwise(F.lit("1.0")).alias(
            "event_version"
        ),
        source.alias("source"),
        F.lit("eia_region_data").alias("dataset"),
        F.lit("eia.region_data.observed").alias("event_type"),
        F.when(hits("event_id", 67, 4), F.lit("  "))
        .otherwise(F.col("respondent"))
        .alias("partition_key"),
        iso("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("emitted_at"),
        F.when(~hits("event_id", 71, 5), F.col("k") >= 50).alias("replay"),
        iso("period", "yyyy-MM-dd'T'HH:mm:ss").alias("source_timestamp"),
        F.when(~hits("event_id", 73, 6), payload).alias("payload"),
    )
    text = F.when(hits("event_id", 53, 1), F.lit("{invalid-json")).otherwise(F.to_json(envelope))
    return events.select(
        F.lit(ELECTRICITY_TOPIC).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("respondent").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
    )


# Records of the raw topic in one of its files, about; a file is written and read by one task.
TOPIC_FILE_ROWS = 100_000


def topic_files(spark: SparkSession, sf: str, folder: str, batches: int) -> int:
    """Write the raw topic to ``folder`` as ``batches`` runs of files and give the files of a run.

    A run is dealt by offset to files of about ``TOPIC_FILE_ROWS`` records, so that no
    task writes or reads a whole run, and a stream that takes the files of a run at a time
    drains the topic in ``batches`` batches at any size. The topic has a record per event.
    """
    per_run = max(1, -(-table(spark, sf, "events").count() // (batches * TOPIC_FILE_ROWS)))
    raw_topic(spark, sf).repartition(batches * per_run, "offset").write.parquet(folder)
    return per_run


def electricity_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return valid_envelopes(parse_envelopes(raw_topic(spark, sf)))


def electricity_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return typed.electricity(electricity_bronze(spark, sf))


def electricity_silver(spark: SparkSession, sf: str) -> DataFrame:
    return typed.latest_valid(electricity_candidates(spark, sf), typed.ELECTRICITY)


def hourly_gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.hourly_grid(electricity_silver(spark, sf))


def grid_mart(spark: SparkSession, sf: str) -> DataFrame:
    return marts.grid_hourly(hourly_gold(spark, sf), marts.respondent_types(spark))


# lineitem + supplier -> weather ----------------------------------------------


def bronze_rows(rows: DataFrame, source: str, dataset: str, event_type: str, payload: Column):
    """Shape rows carrying the bus columns as Bronze rows of one source."""
    return rows.select(
        F.lit(source).alias("source"),
        "event_id",
        F.lit("1.0").alias("event_version"),
        F.lit(dataset).alias("dataset"),
        F.lit(event_type).alias("event_type"),
        "partition_key",
        iso("emitted").alias("emitted_at"),
        "replay",
        iso("emitted").alias("source_timestamp"),
        F.lit(f"{NAMESPACE}.{event_type}").alias("topic"),
        "partition",
        "offset",
        "kafka_timestamp",
        F.col("partition_key").alias("kafka_key"),
        F.to_json(payload).alias("payload_json"),
    )


def weather_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Line items read as forecasts at their supplier's nation."""
    lines = dealt(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    joined = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    shipped = F.col("l_shipdate").cast("timestamp")
    start = shipped + F.make_interval(hours=(F.col("l_linenumber") % 2 * 12).cast("int"))
    offset = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")
    return joined.select(
        "*",
        (F.col("s_nationkey") * 3.5 - 40.0).alias("latitude"),
        (F.col("s_nationkey") * 7.25 - 120.0).alias("longitude"),
        start.alias("start"),
        shipped.alias("emitted"),
        (shipped + F.make_interval(secs=F.col("l_orderkey") % 1000)).alias("kafka_timestamp"),
        (F.col("l_linenumber") % 3).cast("int").alias("partition"),
        offset.alias("offset"),
        F.concat(F.lit("wx-"), offset).alias("event_id"),
        F.concat(F.lit("nation-"), "s_nationkey").alias("partition_key"),
        (F.col("l_returnflag") == "R").alias("replay"),
    )


def weather_payload() -> Column:
    """Forecast payload of a weather row, with defects."""
    no_length = (F.col("l_linenumber") == 7) & (F.col("l_discount") == 0.1)
    end = F.when(no_length, F.col("start")).otherwise(F.col("start") + F.expr("INTERVAL 1 HOUR"))
    unit = (
        F.when((F.col("l_linenumber") == 6) & (F.col("l_quantity") < 10), F.lit("K"))
        .when(F.col("l_returnflag") == "N", F.lit("C"))
        .otherwise(F.lit("F"))
    )
    wet = (F.col("l_linenumber") == 5) & (F.col("l_quantity") == 50)
    silent = (F.col("l_linenumber") == 3) & (F.col("l_quantity") == 1)
    return F.struct(
        "latitude",
        "longitude",
        iso("start").alias("period_start"),
        iso(end).alias("period_end"),
        F.col("l_quantity").alias("temperature"),
        unit.alias("temperature_unit"),
        F.when(F.col("l_tax") != 0, F.col("l_discount") * 1000.0).alias(
            "precipitation_probability"
        ),
        F.when(wet, F.lit(150.0)).otherwise(F.col("l_tax") * 1250.0).alias("relative_humidity"),
        F.concat(F.col("l_linenumber"), F.lit(" mph")).alias("wind_speed"),
        F.col("l_returnflag").alias("wind_direction"),
        F.when(silent, F.lit("")).otherwise(F.col("l_linestatus")).alias("short_forecast"),
    )


def weather_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_rows(
        weather_rows(spark, sf),
        "nws",
        "nws_hourly_forecast",
        "nws.forecast.hourly",
        weather_payload(),
    )


def weather_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return typed.weather(weather_bronze(spark, sf))


def weather_silver(spark: SparkSession, sf: str) -> DataFrame:
    return typed.latest_valid(weather_candidates(spark, sf), typed.WEATHER)


def weather_gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.hourly_weather(weather_silver(spark, sf))


def weather_mart(spark: SparkSession, sf: str) -> DataFrame:
    # stored as Gold is: the mart counts its rows per day and numbers them
    return marts.weather_forecast(durable(weather_gold(spark, sf)))


# customer -> charging stations -----------------------------------------------


def station_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Customers read as stations; every fourth one was reported twice."""
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = dealt(table(spark, sf, "customer"), "c_custkey").join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    versions = F.when(key % 4 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    base = F.lit("2026-01-01 00:00:00").cast("timestamp")
    reported = base + F.make_interval(mins=key.cast("int"))
    shift = F.when(key % 8 == 0, F.col("version")).otherwise(-F.col("version"))
    return customers.select("*", F.explode(versions).alias("version")).select(
        "*",
        (reported + F.make_interval(days=shift)).alias("updated"),
        (base + F.make_interval(hours=F.col("version"))).alias("emitted"),
        (base + F.make_interval(hours=F.col("version"))).alias("kafka_timestamp"),
        (key % 3).cast("int").alias("partition"),
        (key * 2 + F.col("version")).alias("offset"),
        F.concat(F.lit("ev-"), key, F.lit("-"), "version").alias("event_id"),
        F.col("r_name").alias("partition_key"),
        (F.col("version") == 1).alias("replay"),
    )


def _station_payload(identifier: str, zip_name: str) -> list:
    key = F.col("c_custkey")
    return [
        key.alias(identifier),
        F.col("c_name").alias("station_name"),
        F.concat(key, F.lit(" Main St")).alias("street_address"),
        F.concat("n_name", F.lit("-"), key % 10).alias("city"),
        F.when(key % 97 == 3, F.col("r_name"))
        .otherwise(F.substring("r_name", 1, 2))
        .alias("state"),
        F.lpad((key % 100000).cast("string"), 5, "0").alias(zip_name),
        F.lit("US").alias("country"),
        (F.col("n_nationkey") * 3.5 - 40.0).alias("latitude"),
        (F.col("n_nationkey") * 7.25 - 120.0).alias("longitude"),
        F.when(key % 89 == 1, F.lit("LPG")).otherwise(F.lit("ELEC")).alias("fuel_type_code"),
        F.when(key % 83 == 2, F.lit("private")).otherwise(F.lit("public")).alias("access_code"),
        F.when(key % 79 == 4, F.lit("P")).otherwise(F.lit("E")).alias("status_code"),
        F.when(key % 13 != 0, F.col("c_mktsegment")).alias("ev_network"),
        F.when(key % 6 != 0, F.array(F.lit("J1772"), F.lit("TESLA"))).alias("ev_connector_types"),
        F.when(key % 5 != 0, key % 3).cast("int").alias("ev_level1_evse_num"),
        F.when(key % 11 != 0, key % 7 + F.col("version")).cast("int").alias("ev_level2_evse_num"),
        F.when(key % 2 != 0, key % 4).cast("int").alias("ev_dc_fast_num"),
        F.lit("GARAGE").alias("facility_type"),
        iso("updated", "yyyy-MM-dd").alias("date_last_confirmed"),
        iso("updated").alias("updated_at"),
    ]


def station_bronze(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.struct(*_station_payload("station_id", "zip_code"))
    return bronze_rows(
        station_rows(spark, sf), "afdc", "afdc_ev_stations", "afdc.ev_station.snapshot", payload
    )


def station_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return typed.stations(station_bronze(spark, sf))


def station_silver(spark: SparkSession, sf: str) -> DataFrame:
    return typed.latest_valid(station_candidates(spark, sf), typed.STATIONS)


def city_gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.city_infrastructure(station_silver(spark, sf))


def city_mart(spark: SparkSession, sf: str) -> DataFrame:
    return marts.city_rankings(city_gold(spark, sf))


# orders -> monthly ledger shaped like the hourly mart -------------------------


def ledger_mart(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly trade per nation, region and world as grid observations.

    Stored once, as a mart is: the scoring operators read their input repeatedly.
    """
    money = "decimal(18,2)"
    orders = table(spark, sf, "orders")
    lines = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(F.col("l_extendedprice").cast(money)).alias("shipped"))
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    entities = F.array(
        F.struct(F.col("n_name").alias("code"), F.lit("balancing_authority").alias("kind")),
        F.struct(F.col("r_name").alias("code"), F.lit("region").alias("kind")),
        F.struct(F.lit("WORLD").alias("code"), F.lit("national").alias("kind")),
    )
    price = F.col("o_totalprice").cast(money)
    by_nation = (
        orders.join(lines, "o_orderkey", "left")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(
            F.date_trunc("month", F.col("o_orderdate").cast("timestamp")).alias("period"),
            "n_name",
            "r_name",
        )
        .agg(
            F.sum(price).alias("price"),
            F.sum(F.when(F.col("o_orderstatus").isin("F", "O"), price)).alias("settled"),
            F.sum("shipped").alias("shipped"),
            F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        )
    )
    monthly = (
        by_nation.select("*", F.explode(entities).alias("entity"))
        .groupBy(
            "period",
            F.col("entity.code").alias("respondent"),
            F.col("entity.kind").alias("entity_type"),
        )
        .agg(
            F.sum("price").cast("double").alias("demand_mwh"),
            (F.sum("settled").cast("double") * 1.5).alias("demand_forecast_mwh"),
            F.sum("shipped").cast("double").alias("net_generation_mwh"),
            F.bool_or("urgent").alias("contains_replay"),
        )
    )
    measured = monthly.withColumns(
        {
            "total_interchange_mwh": F.col("net_generation_mwh") - F.col("demand_mwh"),
            "respondent_name": F.concat(F.lit("Area "), "respondent"),
        }
    ).withColumns(gold.hourly_measures())
    return durable(measured)


# events -> run log -------------------------------------------------------------


def run_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Consecutive events as start and end of a run, as JSON log lines."""
    events = metric_events(spark, sf).withColumn("run_no", F.floor(F.col("event_id") / 2))
    starts = events.where("event_id % 2 = 0").select("run_no", F.col("ts").alias("started"))
    ends = events.where("event_id % 2 = 1").select(
        "run_no", "event_id", "event_type", "k", F.col("ts").alias("finished")
    )
    stage = F.element_at(
        F.array(*[F.lit(name) for name in STAGES]), (F.col("run_no") % 4 + 1).cast("int")
    )
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    common = [
        F.concat(F.lit("run-"), "run_no").alias("run_id"),
        stage.alias("stage"),
    ]
    command = F.array(F.lit("run"), stage).alias("command")
    started = starts.select(
        (F.col("run_no") * 8).alias("line_no"),
        F.to_json(
            F.struct(
                *common, F.lit("STARTED").alias("status"), iso("started", micros).alias("started_at"), command
            )
        ).alias("line"),
    )
    failed = F.col("event_type") == "error"
    millis = F.unix_millis("finished") - F.unix_millis("started")
    finished = (
        starts.join(ends, "run_no")
        .where("event_id % 40 != 39")
        .select(
            (F.col("run_no") * 8 + 4).alias("line_no"),
            F.to_json(
                F.struct(
                    *common,
                    F.when(failed, "FAILED").otherwise("SUCCEEDED").alias("status"),
                    iso("started", micros).alias("started_at"),
                    iso("finished", micros).alias("finished_at"),
                    (millis / 1000.0).alias("duration_seconds"),
                    F.when(failed, 1).otherwise(0).alias("exit_code"),
                    F.when(F.col("k") >= 10, F.col("k") * 10).alias("records_processed"),
                    command,
                )
            ).alias("line"),
        )
    )
    broken = events.where("event_id % 45 = 0").select(
        (F.col("run_no") * 8 + 6).alias("line_no"),
        F.when(F.col("event_id") % 2 == 0, F.lit("{broken")).otherwise(F.lit("")).alias("line"),
    )
    return started.unionByName(finished).unionByName(broken)


def run_states(spark: SparkSession, sf: str) -> DataFrame:
    return parse_run_log(run_log_lines(spark, sf))


def component_states(spark: SparkSession, sf: str) -> DataFrame:
    """Component health read from the share of error events."""
    names = ("warehouse", "kafka", "prometheus", "kafka_consumer")
    name = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("user_id") % 4 + 1).cast("int"))
    counted = (
        table(spark, sf, "events")
        .groupBy(name.alias("name"))
        .agg(
            F.count("*").alias("events"),
            F.count_if(F.col("event_type") == "error").alias("errors"),
            F.max("value").alias("latency_ms"),
        )
    )
    share = F.col("errors") / F.col("events")
    status = (
        F.when(share > 0.205, "unhealthy").when(share > 0.198, "degraded").otherwise("healthy")
    )
    detail = F.concat(F.col("errors"), F.lit(" of "), "events", F.lit(" events are errors."))
    return counted.select("name", status.alias("status"), detail.alias("detail"), "latency_ms")


# events -> landed snapshots ------------------------------------------------------


def landed_snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Daily snapshots of electricity records, with metadata and record defects."""
    events = metric_events(spark, sf)
    slot = F.col("user_id") % 50
    day_no = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    keyed = events.select(
        "*",
        F.concat(F.lit("snap-"), slot, F.lit("-"), iso("ts", "yyyyMMdd")).alias("snapshot"),
        (day_no * 50 + slot).alias("snapshot_no"),
    )
    fields = {
        "period": iso("period", "yyyy-MM-dd'T'HH"),
        "respondent": F.col("respondent"),
        "respondent-name": F.concat(F.lit("Respondent "), "respondent"),
        "type": F.col("record_type"),
        "type-name": F.col("event_type"),
        "value": F.when(hits("event_id", 227, 7), F.lit("abc")).otherwise(
            F.col("value").cast("string")
        ),
        "value-units": F.when(~hits("event_id", 223, 5), F.lit("megawatthours")),
        "extra": F.when(hits("event_id", 211, 3), F.lit("surplus")),
    }
    records = keyed.select(
        "snapshot",
        F.col("event_id").alias("position"),
        F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()])).alias(
            "record"
        ),
    )
    counted = keyed.groupBy("snapshot", "snapshot_no").agg(F.count("*").alias("found"))
    metadata = F.struct(
        F.lit("eia").alias("source"),
        F.lit("electricity/rto/region-data").alias("dataset"),
        F.lit("1.0").alias("schema_version"),
        F.when(F.col("snapshot_no") % 41 != 2, F.col("snapshot")).alias("run_id"),
        F.lit(NOW).alias("ingested_at"),
        F.when(F.col("snapshot_no") % 37 == 1, F.col("found") + 1)
        .otherwise(F.col("found"))
        .alias("record_count"),
    )
    return counted.select("snapshot", F.to_json(metadata).alias("metadata")), records


def payload_records(rows: DataFrame, payload: Column, query_state: Column) -> DataFrame:
    """Rows as landed records, NULL fields written out."""
    return rows.select(
        F.col("partition_key").alias("snapshot"),
        F.col("offset").alias("position"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("record"),
        query_state.alias("query_state"),
    )


def weather_records(spark: SparkSession, sf: str) -> DataFrame:
    return payload_records(
        weather_rows(spark, sf), weather_payload(), F.lit(None).cast("string")
    )


def station_records(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.struct(*_station_payload("station_id", "zip_code"))
    return payload_records(station_rows(spark, sf), payload, F.substring("r_name", 1, 2))


def _snapshot_metadata(rows: DataFrame, source: str, dataset: str, *by_state: Column) -> DataFrame:
    """Metadata of snapshots, some with a wrong count, without run id or with the count as text."""
    number = F.col("snapshot_no")
    counted = rows.groupBy("snapshot", "snapshot_no").agg(F.count("*").alias("found"))
    metadata = F.to_json(
        F.struct(
            F.lit(source).alias("source"),
            F.lit(dataset).alias("dataset"),
            F.lit("1.0").alias("schema_version"),
            F.when(number % 41 != 2, F.col("snapshot")).alias("run_id"),
            F.lit(NOW).alias("ingested_at"),
            F.when(number % 37 == 1, F.col("found") + 1).otherwise(F.col("found")).alias("record_count"),
            *by_state,
        )
    )
    as_text = F.regexp_replace(metadata, r'"record_count":(\d+)', '"record_count":"$1"')
    return counted.select("snapshot", F.when(number % 43 == 3, as_text).otherwise(metadata).alias("metadata"))


def weather_snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Daily forecasts of a nation as landed snapshots; every fourth record writes 40.0 as 40."""
    day = F.datediff(F.to_date("emitted"), F.lit("1992-01-01").cast("date"))
    rows = weather_rows(spark, sf).withColumns(
        {
            "partition_key": F.concat_ws("-", "partition_key", iso("emitted", "yyyyMMdd")),
            "snapshot_no": day * 25 + F.col("s_nationkey"),
        }
    )
    payload = weather_payload()
    records = payload_records(rows, payload, F.lit(None).cast("string"))
    whole = F.regexp_replace("record", r'("l(?:at|ong)itude":-?\d+)\.0,', "$1,")
    # the line number is in the position, which is made of it
    short = F.floor(F.col("position") / 1_000_000) % 8 % 4 == 1
    named = rows.withColumnRenamed("partition_key", "snapshot")
    return (
        _snapshot_metadata(named, "nws", "nws_hourly_forecast"),
        records.drop("query_state").withColumn("record", F.when(short, whole).otherwise(F.col("record"))),
    )


def station_snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Stations of a state in 300 landed snapshots each, some with bad totals or a bad state."""
    state, slot = F.substring("r_name", 1, 2), F.col("c_custkey") % 300
    rows = station_rows(spark, sf).withColumns(
        {
            "partition_key": F.concat_ws("-", state, slot),
            "snapshot_no": slot + 300 * F.col("n_regionkey"),
        }
    )
    payload = F.struct(*_station_payload("station_id", "zip_code"))
    records = payload_records(rows, payload, state).drop("query_state")
    number, found = F.col("snapshot_no"), F.col("found")
    total = (
        F.when(number % 29 == 3, found - 1).when(number % 23 != 5, found + 4).alias("total_results")
    )
    code = F.when(number % 31 == 4, "O1").otherwise(F.substring("snapshot", 1, 2)).alias("query_state")
    named = rows.withColumnRenamed("partition_key", "snapshot")
    return _snapshot_metadata(named, "afdc", "afdc_ev_stations", code, total), records


# provider responses ---------------------------------------------------------------


def electricity_responses(spark: SparkSession, sf: str) -> DataFrame:
    """One response with two records per event; numbers arrive as text."""
    events = metric_events(spark, sf)

    def record(kind: Column, value: Column) -> Column:
        return F.struct(
            iso("period", "yyyy-MM-dd'T'HH").alias("period"),
            F.col("respondent").alias("respondent"),
            F.concat(F.lit("Respondent "), "respondent").alias("respondent-name"),
            kind.alias("type"),
            F.col("event_type").alias("type-name"),
            value.cast("string").alias("value"),
            F.lit("MegawattHours").alias("value-units"),
        )

    data = F.array(
        record(F.col("record_type"), F.col("value")), record(F.lit("K"), F.col("k"))
    )
    body = F.struct(F.struct(F.lit("2").alias("total"), data.alias("data")).alias("response"))
    return events.select(F.to_json(body).alias("body"))


def weather_responses(spark: SparkSession, sf: str) -> DataFrame:
    """One response with one forecast period per line item."""
    rows = weather_rows(spark, sf)

    def quantity(value: Column) -> Column:
        return F.struct(F.lit("wmoUnit:percent").alias("unitCode"), value.alias("value"))

    period = F.struct(
        iso("start").alias("startTime"),
        iso(F.col("start") + F.expr("INTERVAL 1 HOUR")).alias("endTime"),
        F.col("l_quantity").alias("temperature"),
        F.lit("F").alias("temperatureUnit"),
        quantity(F.when(F.col("l_tax") != 0, F.col("l_discount") * 1000.0)).alias(
            "probabilityOfPrecipitation"
        ),
        F.when(F.col("l_linenumber") != 4, quantity(F.col("l_tax") * 1250.0)).alias(
            "relativeHumidity"
        ),
        F.concat(F.col("l_linenumber"), F.lit(" mph")).alias("windSpeed"),
        F.col("l_returnflag").alias("windDirection"),
        F.col("l_linestatus").alias("shortForecast"),
    )
    body = F.struct(F.struct(F.array(period).alias("periods")).alias("properties"))
    return rows.select("latitude", "longitude", F.to_json(body).alias("body"))


def station_responses(spark: SparkSession, sf: str) -> DataFrame:
    """One response with one station per customer report."""
    station = F.struct(*_station_payload("id", "zip"))
    body = F.struct(F.lit(1).alias("total_results"), F.array(station).alias("fuel_stations"))
    return station_rows(spark, sf).select(F.to_json(body).alias("body"))


