"""Batch jobs between the stored layers."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from amperline.operators import gold, marts, typed
from amperline.operators.quality import layer_counts, quality_snapshot
from amperline.sources.tables import LAYERS, read_layer, table_path, write_layer

SILVER_TABLES = {
    "silver_electricity": typed.ELECTRICITY,
    "silver_weather": typed.WEATHER,
    "silver_stations": typed.STATIONS,
}
GOLD_TABLES = {
    "gold_hourly": ("silver_electricity", gold.hourly_grid),
    "gold_weather": ("silver_weather", gold.hourly_weather),
    "gold_city": ("silver_stations", gold.city_infrastructure),
}
MARTS = (
    "mart_grid_hourly",
    "mart_balancing_authority_performance",
    "mart_weather_forecast",
    "mart_ev_city_rankings",
)


def _observed(frame: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written instead of running the plan again."""
    seen = Observation(name)
    return frame.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _rows(seen: Observation, spark: SparkSession, root: str, name: str) -> int:
    """Observed rows; a plan that the optimizer found empty leaves nothing to observe, then footers are asked."""
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        return read_layer(spark, root, name).count()


def build_silver(spark: SparkSession, root: str) -> dict[str, int]:
    """Rebuild the Silver tables and the quarantine; returns rows written."""
    bronze = read_layer(spark, root, "bronze_events")
    if bronze is None:
        raise ValueError("the Bronze table does not exist")
    written: dict[str, int] = {}
    candidates = {}
    for name, spec in SILVER_TABLES.items():
        candidates[spec.source] = typed.typed_candidates(bronze, spec)
        silver, seen = _observed(typed.latest_valid(candidates[spec.source], spec), name)
        write_layer(silver, root, name)
        written[name] = _rows(seen, spark, root, name)
    rejected, seen = _observed(typed.quarantined(candidates), "silver_quarantine")
    write_layer(rejected, root, "silver_quarantine")
    written["silver_quarantine"] = _rows(seen, spark, root, "silver_quarantine")
    return written


def build_gold(spark: SparkSession, root: str) -> dict[str, int]:
    """Rebuild the Gold tables; returns rows written."""
    written: dict[str, int] = {}
    for name, (silver, build) in GOLD_TABLES.items():
        source = read_layer(spark, root, silver)
        if source is None:
            raise ValueError(f"{silver} does not exist")
        frame, seen = _observed(build(source), name)
        write_layer(frame, root, name)
        written[name] = _rows(seen, spark, root, name)
    return written


def build_marts(spark: SparkSession, root: str, seed_csv: str | None = None) -> dict[str, DataFrame]:
    """Write the marts, register them as views and return them."""
    layers = {name: read_layer(spark, root, name) for name in GOLD_TABLES}
    absent = [name for name, frame in layers.items() if frame is None]
    if absent:
        raise ValueError(f"Gold tables missing: {', '.join(absent)}")
    for name, stage in (
        ("gold_hourly", marts.staged_grid),
        ("gold_weather", marts.staged_weather),
        ("gold_city", marts.staged_cities),
    ):
        stage(layers[name]).createOrReplaceTempView(name.replace("gold_", "stg_"))

    def stored(name: str, frame: DataFrame) -> DataFrame:
        path = table_path(root, name)
        frame.write.mode("overwrite").parquet(path)
        table = spark.read.schema(frame.schema).parquet(path)
        table.createOrReplaceTempView(name)
        return table

    types = marts.respondent_types(spark, seed_csv)
    grid = stored("mart_grid_hourly", marts.grid_hourly(layers["gold_hourly"], types))
    return {
        "mart_grid_hourly": grid,
        "mart_balancing_authority_performance": stored(
            "mart_balancing_authority_performance", marts.authority_performance(grid)
        ),
        "mart_weather_forecast": stored(
            "mart_weather_forecast", marts.weather_forecast(layers["gold_weather"])
        ),
        "mart_ev_city_rankings": stored(
            "mart_ev_city_rankings", marts.city_rankings(layers["gold_city"])
        ),
    }


def stored_quality(spark: SparkSession, root: str) -> DataFrame:
    """Quality snapshot of the layers as they are stored now."""
    counted = []
    for name, layer in LAYERS.items():
        if layer.layer != "BRONZE_QUARANTINE":
            counted.append((layer.layer, layer.dataset, read_layer(spark, root, name)))
    bronze = read_layer(spark, root, "bronze_events")
    routed = [spec.source for spec in typed.TYPED_SOURCES]
    unrouted = None if bronze is None else bronze.where(~F.col("source").isin(*routed))
    counted.append(("NOT_ROUTED", "All", unrouted))
    return quality_snapshot(layer_counts(spark, counted))
