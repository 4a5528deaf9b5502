"""Landed snapshots checked against declared data contracts.

A contract is driver-side configuration. It is compiled into Columns, so many
snapshots are validated in one distributed pass; a snapshot fails as a whole
with the first reason found, in the documented order of the checks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amperline.functions.clock import parse_hour
from amperline.functions.parsing import parsed_once
from amperline.functions.rules import Rule, first_failure
from amperline.session import durable

_METADATA = ("source", "dataset", "schema_version", "run_id", "ingested_at", "record_count")
_ISO_OFFSET = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$"
_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_WHOLE = r"^[+-]?\d+(\.0*)?$"


@dataclass(frozen=True)
class Contract:
    """Fields, keys, metadata and record rules of one landed dataset."""

    name: str
    source: str
    fields: tuple[str, ...]
    unique_key: tuple[str, ...]
    record_rules: Callable[[], list[Rule]]
    required_metadata: tuple[str, ...] = _METADATA
    by_state: bool = False
    numeric_keys: tuple[str, ...] = ()


def with_fields(records: DataFrame) -> DataFrame:
    """Add ``fields``, the record's JSON object as a map of texts."""
    return records.select("*", parsed_once("record", "MAP<STRING, STRING>").alias("fields"))


def raw(name: str) -> Column:
    """Field of the record as text; NULL when absent or JSON null."""
    return F.try_element_at("fields", F.lit(name))


def _text_missing(name: str) -> Column:
    return F.coalesce(F.trim(raw(name)), F.lit("")) == ""


def _not(pattern: str, name: str) -> Column:
    """Present values that do not match; NULL counts as a violation."""
    return ~F.coalesce(raw(name).rlike(pattern), F.lit(False))


def _present_but_not(pattern: str, name: str) -> Column:
    return ~F.coalesce(raw(name).rlike(pattern), F.lit(True))


def _number_outside(name: str, low: float, high: float) -> Column:
    return ~F.coalesce(raw(name).try_cast("double").between(low, high), F.lit(False))


def _electricity_rules() -> list[Rule]:
    return [
        ("invalid_period", parse_hour(raw("period")).isNull()),
        *[
            (f"empty_{name}", _text_missing(name))
            for name in ("respondent", "respondent-name", "type", "type-name")
        ],
        ("invalid_value", _not(_NUMBER, "value")),
        ("missing_value-units", raw("value-units").isNull()),
    ]


def _weather_rules() -> list[Rule]:
    return [
        *[(f"invalid_{name}", _not(_NUMBER, name)) for name in ("latitude", "longitude")],
        *[(f"invalid_{name}", _not(_ISO_OFFSET, name)) for name in ("period_start", "period_end")],
        ("invalid_temperature", _not(_NUMBER, "temperature")),
        *[
            (f"invalid_{name}", _present_but_not(_NUMBER, name))
            for name in ("precipitation_probability", "relative_humidity")
        ],
        *[
            (f"empty_{name}", _text_missing(name))
            for name in ("temperature_unit", "wind_speed", "wind_direction", "short_forecast")
        ],
        (
            "invalid_forecast_interval",
            F.try_to_timestamp(raw("period_end")) <= F.try_to_timestamp(raw("period_start")),
        ),
    ]


def _station_rules() -> list[Rule]:
    return [
        ("invalid_station_id", _not(_WHOLE, "station_id")),
        *[
            (f"empty_{name}", _text_missing(name))
            for name in ("station_name", "city", "state", "zip_code", "country")
        ],
        ("invalid_latitude", _number_outside("latitude", -90, 90)),
        ("invalid_longitude", _number_outside("longitude", -180, 180)),
        *[
            (f"invalid_{name}", ~F.coalesce(raw(name) == value, F.lit(False)))
            for name, value in (
                ("fuel_type_code", "ELEC"),
                ("access_code", "public"),
                ("status_code", "E"),
            )
        ],
        *[
            (f"invalid_{name}", _present_but_not(r"^\+?\d+(\.0*)?$", name))
            for name in ("ev_level1_evse_num", "ev_level2_evse_num", "ev_dc_fast_num")
        ],
        (
            "invalid_ev_connector_types",
            F.from_json(raw("ev_connector_types"), "array<string>").isNull(),
        ),
        *[
            (
                f"invalid_{name}",
                raw(name).isNotNull() & F.try_to_timestamp(raw(name)).isNull(),
            )
            for name in ("date_last_confirmed", "updated_at")
        ],
        ("state_mismatch", F.upper(F.trim(raw("state"))) != F.upper("query_state")),
    ]


# Contract fields, unique keys and required metadata.
ELECTRICITY_CONTRACT = Contract(
    name="eia_region_data",
    source="eia",
    fields=(
        "period",
        "respondent",
        "respondent-name",
        "type",
        "type-name",
        "value",
        "value-units",
    ),
    unique_key=("period", "respondent", "type"),
    record_rules=_electricity_rules,
)
WEATHER_CONTRACT = Contract(
    name="nws_hourly_forecast",
    source="nws",
    fields=(
        "latitude",
        "longitude",
        "period_start",
        "period_end",
        "temperature",
        "temperature_unit",
        "precipitation_probability",
        "relative_humidity",
        "wind_speed",
        "wind_direction",
        "short_forecast",
    ),
    unique_key=("latitude", "longitude", "period_start"),
    numeric_keys=("latitude", "longitude"),
    record_rules=_weather_rules,
)
STATION_CONTRACT = Contract(
    name="afdc_ev_stations",
    source="afdc",
    fields=(
        "station_id",
        "station_name",
        "street_address",
        "city",
        "state",
        "zip_code",
        "country",
        "latitude",
        "longitude",
        "fuel_type_code",
        "access_code",
        "status_code",
        "ev_network",
        "ev_connector_types",
        "ev_level1_evse_num",
        "ev_level2_evse_num",
        "ev_dc_fast_num",
        "facility_type",
        "date_last_confirmed",
        "updated_at",
    ),
    unique_key=("station_id",),
    numeric_keys=("station_id",),
    record_rules=_station_rules,
    required_metadata=(*_METADATA, "query_state", "total_results"),
    by_state=True,
)
CONTRACTS = {
    contract.source: contract
    for contract in (ELECTRICITY_CONTRACT, WEATHER_CONTRACT, STATION_CONTRACT)
}


def contract_from_mapping(source: str, loaded: dict) -> Contract:
    """Contract from an already parsed contract file, with the source's rules."""
    return Contract(
        name=loaded["dataset"]["name"],
        source=source,
        fields=tuple(loaded["schema"]["fields"]),
        unique_key=tuple(loaded["quality"]["uniqueness"]["columns"]),
        record_rules=CONTRACTS[source].record_rules,
        required_metadata=tuple(loaded["metadata"]["required"]),
        by_state=CONTRACTS[source].by_state,
        numeric_keys=CONTRACTS[source].numeric_keys,
    )


def _whole_number(name: str) -> Column:
    """Metadata number when it is written as a JSON integer, not as text."""
    written = F.col("metadata").rlike(rf'"{name}"\s*:\s*-?\d+\s*[,}}]')
    return F.when(written, F.get_json_object("metadata", f"$.{name}").try_cast("long"))


def snapshot_rules(contract: Contract) -> list[Rule]:
    """Checks on the metadata and the record count of a snapshot."""
    keys = F.json_object_keys("metadata")
    lacking = F.array_except(F.array(*[F.lit(k) for k in contract.required_metadata]), keys)
    rules = [
        ("missing_metadata", keys.isNull()),
        ("missing_required_metadata", F.size(lacking) > 0),
        ("missing_records", ~F.col("has_records")),
        ("record_count_not_integer", F.col("declared").isNull()),
        ("record_count_mismatch", F.col("declared") != F.col("record_count")),
    ]
    if contract.by_state:
        rules += [
            ("total_results_not_integer", F.col("total_results").isNull()),
            ("total_results_too_small", F.col("total_results") < F.col("declared")),
            (
                "invalid_query_state",
                ~F.coalesce(F.col("query_state").rlike("^[A-Za-z]{2}$"), F.lit(False)),
            ),
        ]
    return rules


def record_violations(records: DataFrame, contract: Contract) -> DataFrame:
    """Every record with ``reason``, the first rule it breaks, or NULL.

    ``records`` has ``snapshot``, ``position``, ``record`` (JSON text) and
    ``query_state``.
    """
    expected = F.array(*[F.lit(name) for name in contract.fields])
    actual = F.map_keys("fields")
    checked = with_fields(records).withColumns(
        {
            "missing_fields": F.array_join(F.array_sort(F.array_except(expected, actual)), ", "),
            "unknown_fields": F.array_join(F.array_sort(F.array_except(actual, expected)), ", "),
        }
    )
    return checked.withColumn(
        "reason",
        first_failure(
            [
                ("record_not_object", actual.isNull()),
                ("missing_fields", F.col("missing_fields") != ""),
                ("unknown_fields", F.col("unknown_fields") != ""),
                *contract.record_rules(),
            ]
        ),
    )


def unique_key(contract: Contract) -> Column:
    """Key of a record; numbers count by value, so 40 and 40.0 are one key."""

    def part(name: str) -> Column:
        text = raw(name)
        number = text.try_cast("double").cast("string")
        return F.coalesce(number, text) if name in contract.numeric_keys else text

    return F.to_json(F.array(*[F.coalesce(part(name), F.lit("None")) for name in contract.unique_key]))


def validate_snapshots(
    snapshots: DataFrame, records: DataFrame, contract: Contract
) -> DataFrame:
    """One verdict per snapshot.

    ``snapshots`` has ``snapshot`` and ``metadata`` (JSON text), ``records`` one
    row per array element. A document without a list of records, as told by an
    optional column ``has_records`` of ``snapshots``, fails. Metadata problems win
    over record problems, which are reported for the record that comes first; on
    one record a broken rule wins over a key that an earlier record had.
    """
    present = F.col("has_records") if "has_records" in snapshots.columns else F.lit(True)
    described = snapshots.withColumns(
        {
            "has_records": F.coalesce(present, F.lit(False)),
            "declared": _whole_number("record_count"),
            "total_results": _whole_number("total_results"),
            "query_state": F.get_json_object("metadata", "$.query_state"),
        }
    )
    # parsed once and stored narrow: the texts of the records take part in no join and no shuffle
    unstated = records.withColumn("query_state", F.lit(None).cast("string"))
    judged = durable(
        record_violations(unstated, contract).select(
            "snapshot",
            "position",
            "reason",
            unique_key(contract).alias("unique_key"),
            F.upper(F.trim(raw("state"))).alias("state"),
        )
    )
    if contract.by_state:
        # the last of the record rules, and the only one that needs the snapshot
        mismatch = F.when(F.col("state") != F.upper("query_state"), "state_mismatch")
        judged = judged.join(described.select("snapshot", "query_state"), "snapshot").withColumn(
            "reason", F.coalesce("reason", mismatch)
        )
    # the first two records of each key are kept in the map tasks already, however often it occurs
    nth = Window.partitionBy("snapshot", "unique_key").orderBy("position")
    per_record = judged.groupBy("snapshot").agg(
        F.count("*").alias("record_count"),
        F.min(
            F.when(F.col("reason").isNotNull(), F.struct("position", F.lit(0).alias("turn"), "reason"))
        ).alias("broken"),
    )
    repeated = F.struct(
        "position", F.lit(1).alias("turn"), F.lit("duplicate_unique_key").alias("reason")
    )
    per_key = (
        judged.withColumn("nth", F.row_number().over(nth))
        .where("nth <= 2")
        .groupBy("snapshot")
        .agg(
            F.count_if(F.col("nth") == 1).alias("unique_key_count"),
            F.min(F.when(F.col("nth") == 2, repeated)).alias("repeated"),
        )
    )
    counted = (
        described.join(per_record, "snapshot", "left")
        .join(per_key, "snapshot", "left")
        .withColumns(
            {
                "record_count": F.coalesce("record_count", F.lit(0)),
                "unique_key_count": F.coalesce("unique_key_count", F.lit(0)),
            }
        )
    )
    reason = F.coalesce(
        first_failure(snapshot_rules(contract)), F.least("broken", "repeated").getField("reason")
    )
    return counted.select(
        "snapshot",
        F.lit(contract.name).alias("contract"),
        "record_count",
        "unique_key_count",
        reason.alias("reason"),
        F.when(reason.isNull(), "PASSED").otherwise("QUARANTINED").alias("verdict"),
    )


def gate(
    snapshots: DataFrame, records: DataFrame, contract: Contract
) -> tuple[DataFrame, DataFrame]:
    """Split records into those of accepted and those of quarantined snapshots."""
    verdicts = validate_snapshots(snapshots, records, contract).select("snapshot", "reason")
    joined = records.join(verdicts, "snapshot")
    return (
        joined.where(F.col("reason").isNull()).drop("reason"),
        joined.where(F.col("reason").isNotNull()),
    )


def normalised_electricity(records: DataFrame) -> DataFrame:
    """Typed electricity records: trimmed text, lower-case units, numeric value."""
    return with_fields(records).select(
        parse_hour(raw("period")).alias("period"),
        F.trim(raw("respondent")).alias("respondent"),
        F.trim(raw("respondent-name")).alias("respondent_name"),
        F.trim(raw("type")).alias("record_type"),
        F.trim(raw("type-name")).alias("type_name"),
        raw("value").try_cast("double").alias("value"),
        F.lower(F.trim(raw("value-units"))).alias("value_units"),
    )


def normalised_weather(records: DataFrame) -> DataFrame:
    """Typed forecast records with trimmed text."""
    numbers = (
        "latitude",
        "longitude",
        "temperature",
        "precipitation_probability",
        "relative_humidity",
    )
    texts = ("temperature_unit", "wind_speed", "wind_direction", "short_forecast")
    return with_fields(records).select(
        *[F.try_to_timestamp(raw(name)).alias(name) for name in ("period_start", "period_end")],
        *[raw(name).try_cast("double").alias(name) for name in numbers],
        *[F.trim(raw(name)).alias(name) for name in texts],
    )


def normalised_stations(records: DataFrame) -> DataFrame:
    """Typed station records: trimmed text, upper-case state and country."""
    trimmed = ("station_name", "city", "zip_code")
    upper = ("state", "country")
    kept = (
        "street_address",
        "fuel_type_code",
        "access_code",
        "status_code",
        "ev_network",
        "facility_type",
    )
    counts = ("ev_level1_evse_num", "ev_level2_evse_num", "ev_dc_fast_num")
    connectors = F.from_json(raw("ev_connector_types"), "array<string>")
    return with_fields(records).select(
        raw("station_id").try_cast("long").alias("station_id"),
        *[F.trim(raw(name)).alias(name) for name in trimmed],
        *[F.upper(F.trim(raw(name))).alias(name) for name in upper],
        *[raw(name).alias(name) for name in kept],
        *[raw(name).try_cast("double").alias(name) for name in ("latitude", "longitude")],
        *[raw(name).try_cast("int").alias(name) for name in counts],
        F.coalesce(connectors, F.array().cast("array<string>")).alias("ev_connector_types"),
        raw("date_last_confirmed").try_cast("date").alias("date_last_confirmed"),
        F.try_to_timestamp(raw("updated_at")).alias("updated_at"),
    )
