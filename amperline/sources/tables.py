"""Layer tables as Parquet with declared schemas."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from amperline.sources import schemas
from amperline.sources.control import ControlTable


@dataclass(frozen=True)
class Layer:
    """Where a table lives, its schema and its partition columns."""

    name: str
    layer: str
    dataset: str
    schema: str
    partitions: tuple[str, ...] = ()


LAYERS = {
    layer.name: layer
    for layer in (
        Layer("bronze_events", "BRONZE", "All", schemas.BRONZE, ("source", "kafka_date", "batch_id")),
        Layer(
            "bronze_quarantine",
            "BRONZE_QUARANTINE",
            "All",
            schemas.BRONZE_QUARANTINE,
            ("batch_id",),
        ),
        Layer(
            "silver_electricity",
            "SILVER",
            "EIA Grid",
            schemas.SILVER_ELECTRICITY,
            ("period_date",),
        ),
        Layer(
            "silver_weather", "SILVER", "NWS Weather", schemas.SILVER_WEATHER, ("forecast_date",)
        ),
        Layer("silver_stations", "SILVER", "AFDC EV", schemas.SILVER_STATIONS, ("state",)),
        Layer("silver_quarantine", "QUARANTINE", "All", schemas.SILVER_QUARANTINE, ("source",)),
        Layer("gold_hourly", "GOLD", "EIA Grid", schemas.GOLD_HOURLY, ("period_date",)),
        Layer("gold_weather", "GOLD", "NWS Weather", schemas.GOLD_WEATHER, ("forecast_date",)),
        Layer("gold_city", "GOLD", "AFDC EV", schemas.GOLD_CITY, ("state",)),
    )
}


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def exists(spark: SparkSession, path: str) -> bool:
    """True when a table was committed, even one without rows."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def layer_columns(name: str) -> list[str]:
    """Columns of a layer in the order of its schema."""
    return StructType.fromDDL(LAYERS[name].schema).names


MERGED = "merged-"


def merged_batches(spark: SparkSession, root: str) -> ControlTable:
    """Which Bronze folders stand for which batches: the manifest of ``compact_bronze``."""
    schema = "source STRING, kafka_date DATE, batch_id STRING, merged_into STRING"
    return ControlTable(spark, table_path(root, "merged_batches"), schema)


def read_layer(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A layer table with its declared schema, or None when it was never written.

    Of Bronze the folders that a merge has replaced are left out, and merged folders
    whose merge was never committed.
    """
    path = table_path(root, name)
    if not exists(spark, path):
        return None
    table = spark.read.schema(LAYERS[name].schema).parquet(path)
    if name == "bronze_events":
        version, merged = merged_batches(spark, root).read()
        whole = ~F.col("batch_id").startswith(MERGED)
        if version:
            folder = list(LAYERS[name].partitions)
            committed = [row[0] for row in merged.select("merged_into").distinct().collect()]
            table = table.where(whole | F.col("batch_id").isin(*committed))
            table = table.join(merged.select(*folder), folder, "left_anti").select(*table.columns)
        else:
            table = table.where(whole)
    return table


def write_layer(frame: DataFrame, root: str, name: str, *, only_touched: bool = False) -> None:
    """Replace a layer table.

    The rebalance hint groups rows by partition value and lets AQE split large
    groups and merge small ones, so a hot date or state does not end in one task
    or one file. With ``only_touched`` just the partitions present in ``frame``
    are replaced.
    """
    layer = LAYERS[name]
    if layer.partitions:
        frame = frame.hint("rebalance", *[F.col(column) for column in layer.partitions])
    writer = frame.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic" if only_touched else "static"
    )
    if layer.partitions:
        writer = writer.partitionBy(*layer.partitions)
    writer.parquet(table_path(root, name))


def export_tables(tables: dict[str, DataFrame], destination: str) -> DataFrame:
    """Write every analytics relation to one folder and count what was written."""
    counted = []
    for name, frame in sorted(tables.items()):
        path = table_path(destination, name)
        frame.write.mode("overwrite").parquet(path)
        written = frame.sparkSession.read.schema(frame.schema).parquet(path)
        counted.append(
            written.agg(F.count("*").alias("rows")).select(F.lit(name).alias("relation"), "rows")
        )
    return reduce(DataFrame.unionByName, counted)
