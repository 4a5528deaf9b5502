"""Landed snapshot documents and provider responses."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from amperline.functions.parsing import parsed_once
from amperline.sources.commits import publish_once, read_published, remove

#: The file whose appearance makes a run visible.
MANIFEST = "manifest.json"

# Objects are kept as JSON text: contract checks need the field names as landed.
_DOCUMENT = "metadata STRING, records ARRAY<STRING>"


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed document: ``snapshot`` (file), ``metadata``, ``records``."""
    return (
        spark.read.schema(_DOCUMENT)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .json(path)
        .select(
            F.input_file_name().alias("snapshot"),
            "metadata",
            "records",
            F.col("records").isNotNull().alias("has_records"),
        )
    )


def snapshot_documents(texts: DataFrame) -> DataFrame:
    """Documents given as text in ``snapshot`` and ``document`` columns."""
    parsed = parsed_once("document", _DOCUMENT)
    documents = texts.select("snapshot", parsed.alias("d")).select("snapshot", "d.*")
    return documents.withColumn("has_records", F.col("records").isNotNull())


def snapshot_records(documents: DataFrame) -> DataFrame:
    """One row per array element: ``snapshot``, ``position``, ``record``."""
    return documents.select("snapshot", F.posexplode("records").alias("position", "record"))


def stage_records(records: DataFrame, folder: str) -> tuple[str, int]:
    """Write the records of a run, one JSON line each, and return the part's name and their number.

    Rows are counted while they are written. What is staged is invisible to readers
    until a manifest names it; a second attempt stages a part of its own.
    """
    spark, part, seen = records.sparkSession, f"records-{uuid.uuid4().hex}", Observation()
    written = records.observe(seen, F.count(F.lit(1)).alias("rows"))
    written.write.option("ignoreNullFields", False).json(f"{folder}/{part}")
    try:
        return part, seen.get["rows"]
    except Py4JJavaError:  # a plan found empty by the optimizer leaves nothing to observe
        return part, spark.read.text(f"{folder}/{part}").count()


def land_snapshot(
    records: DataFrame,
    root: str,
    *,
    source: str,
    dataset: str,
    run_id: str,
    ingested_at: str,
    query_state: str | None = None,
    total_results: int | None = None,
) -> int:
    """Write an immutable snapshot of records under today's ingestion date.

    Records become one JSON line each, so a large snapshot is written in parallel.
    The manifest with the metadata comes last and is the one commit of the run: a run
    that broke off before has none and is not seen. An existing run is never
    overwritten; of two writers of one run the second fails and removes its records.
    """
    spark = records.sparkSession
    folder = f"{root.rstrip('/')}/ingestion_date={ingested_at[:10]}/run_id={run_id}"
    manifest = f"{folder}/{MANIFEST}"
    if read_published(spark, manifest) is not None:
        raise FileExistsError(f"run {run_id} exists already")
    state = query_state.strip().upper() if query_state is not None else None
    if state is not None and not (len(state) == 2 and state.isalpha()):
        raise ValueError("query_state must be a two-letter state code")
    part, total = stage_records(records, folder)
    metadata: dict[str, object] = {
        "source": source,
        "dataset": dataset,
        "schema_version": "1.0",
        "run_id": run_id,
        "ingested_at": ingested_at,
        "record_count": total,
    }
    try:
        if total == 0:
            raise ValueError("an empty snapshot is not written")
        if state is not None:
            if total_results is None or total_results < total:
                raise ValueError("total_results cannot be smaller than the record count")
            metadata |= {"query_state": state, "total_results": total_results}
        if not publish_once(spark, manifest, {"metadata": metadata, "records": part}):
            raise FileExistsError(f"run {run_id} was landed by another writer")
    except (ValueError, FileExistsError):
        remove(spark, f"{folder}/{part}")
        raise
    return total


def read_landed_runs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Snapshots and records of runs written by ``land_snapshot``.

    Both are keyed by the run folder, in the shape the contract checks expect. Records
    that no manifest names, of a run that broke off, are left out.
    """
    base = root.rstrip("/")
    run = F.regexp_extract(F.input_file_name(), r"run_id=([^/]+)/", 1).alias("snapshot")
    part = F.regexp_extract(F.input_file_name(), r"/(records-[^/]+)/", 1).alias("part")
    manifests = spark.read.text(f"{base}/*/*/{MANIFEST}", wholetext=True).select(
        run,
        F.get_json_object("value", "$.records").alias("part"),
        F.get_json_object("value", "$.metadata").alias("metadata"),
    )
    records = spark.read.text(f"{base}/*/*/records-*").select(
        run, part, F.monotonically_increasing_id().alias("position"), F.col("value").alias("record")
    )
    landed = records.join(manifests.select("snapshot", "part"), ["snapshot", "part"], "left_semi")
    return manifests.drop("part").withColumn("has_records", F.lit(True)), landed.drop("part")


# Provider responses ---------------------------------------------------------

_ELECTRICITY_RESPONSE = (
    "response STRUCT<total: STRING, data: ARRAY<STRUCT<period: STRING, respondent: STRING, "
    "`respondent-name`: STRING, type: STRING, `type-name`: STRING, value: STRING, "
    "`value-units`: STRING>>>"
)
_QUANTITY = "STRUCT<unitCode: STRING, value: DOUBLE>"
_WEATHER_RESPONSE = (
    "properties STRUCT<periods: ARRAY<STRUCT<startTime: STRING, endTime: STRING, "
    "temperature: DOUBLE, temperatureUnit: STRING, "
    f"probabilityOfPrecipitation: {_QUANTITY}, relativeHumidity: {_QUANTITY}, "
    "windSpeed: STRING, windDirection: STRING, shortForecast: STRING>>>"
)
_STATION_RESPONSE = (
    "total_results BIGINT, fuel_stations ARRAY<STRUCT<id: BIGINT, station_name: STRING, "
    "street_address: STRING, city: STRING, state: STRING, zip: STRING, country: STRING, "
    "latitude: DOUBLE, longitude: DOUBLE, fuel_type_code: STRING, access_code: STRING, "
    "status_code: STRING, ev_network: STRING, ev_connector_types: ARRAY<STRING>, "
    "ev_level1_evse_num: INT, ev_level2_evse_num: INT, ev_dc_fast_num: INT, "
    "facility_type: STRING, date_last_confirmed: STRING, updated_at: STRING>>"
)


def _items(responses: DataFrame, schema: str, array: str, *keep: str, total: Column) -> DataFrame:
    parsed = responses.select(*keep, parsed_once("body", schema).alias("answer"))
    return parsed.select(
        *keep, total.alias("total_available"), F.explode(f"answer.{array}").alias("item")
    )


def flatten_electricity(responses: DataFrame) -> DataFrame:
    """``response.data[]`` rows; value and total arrive as text."""
    total = F.col("answer.response.total").try_cast("long")
    return _items(responses, _ELECTRICITY_RESPONSE, "response.data", total=total).select(
        "total_available",
        "item.period",
        "item.respondent",
        F.col("item.`respondent-name`").alias("respondent_name"),
        F.col("item.type").alias("record_type"),
        F.col("item.`type-name`").alias("type_name"),
        F.col("item.value").try_cast("double").alias("value"),
        F.col("item.`value-units`").alias("value_units"),
    )


def flatten_weather(responses: DataFrame, limit: int | None = None) -> DataFrame:
    """``properties.periods[]`` rows of a located response.

    ``responses`` has ``latitude``, ``longitude`` and ``body``; ``limit`` keeps
    the first periods of each response, as a client asking for fewer hours does.
    """
    parsed = responses.select(
        "latitude", "longitude", parsed_once("body", _WEATHER_RESPONSE).alias("answer")
    )
    periods = F.col("answer.properties.periods")
    if limit is not None:
        if limit < 1:
            raise ValueError("limit must be greater than zero")
        periods = F.slice(periods, 1, limit)
    return parsed.select("latitude", "longitude", F.explode(periods).alias("item")).select(
        "latitude",
        "longitude",
        F.col("item.startTime").alias("period_start"),
        F.col("item.endTime").alias("period_end"),
        "item.temperature",
        F.col("item.temperatureUnit").alias("temperature_unit"),
        F.col("item.probabilityOfPrecipitation.value").alias("precipitation_probability"),
        F.col("item.relativeHumidity.value").alias("relative_humidity"),
        F.col("item.windSpeed").alias("wind_speed"),
        F.col("item.windDirection").alias("wind_direction"),
        F.col("item.shortForecast").alias("short_forecast"),
    )


def flatten_stations(responses: DataFrame) -> DataFrame:
    """``fuel_stations[]`` rows with the record's own names; no connectors is []."""
    total = F.col("answer.total_results")
    items = _items(responses, _STATION_RESPONSE, "fuel_stations", total=total)
    return (
        items.select("total_available", "item.*")
        .withColumnsRenamed({"id": "station_id", "zip": "zip_code"})
        .withColumn(
            "ev_connector_types",
            F.coalesce("ev_connector_types", F.array().cast("array<string>")),
        )
    )
