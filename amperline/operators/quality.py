"""Layer counts, conservation from Bronze to Silver, and model tests."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperline.functions.numeric import shown
from amperline.operators.typed import TypedSource


def layer_counts(spark, layers: Iterable[tuple[str, str, DataFrame | None]]) -> DataFrame:
    """Rows per (layer, dataset); a table that does not exist counts as NULL."""
    parts = []
    for layer, dataset, frame in layers:
        counted = (
            spark.range(1).select(F.lit(None).cast("long").alias("rows"))
            if frame is None
            else frame.agg(F.count("*").alias("rows"))
        )
        parts.append(counted.select(F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset"), "rows"))
    return reduce(DataFrame.unionByName, parts)


def source_counts(
    candidates: DataFrame, spec: TypedSource, grain: tuple[str, ...] | None
) -> DataFrame:
    """Rows that one source has in Bronze, Silver, Gold and quarantine, without writing a layer.

    Silver holds one row per business key with a valid record, so its rows are the keys.
    Gold is grouped by ``grain`` of the newest record of each key, or has a row for each
    Silver row if there is no grain. Only these columns are carried, counts are summed
    in the map tasks, and no row is stored.
    """
    valid = F.col("is_valid")
    newest = F.struct(*spec.newest_by, "event_emitted_at", "kafka_timestamp", "partition", "offset")
    shown_as = F.max_by(F.struct(*grain), newest) if grain else F.lit(None)
    per_key = candidates.groupBy(
        "is_valid", *[F.when(valid, F.col(name)).alias(name) for name in spec.business_key]
    ).agg(F.count("*").alias("records"), shown_as.alias("grain"))
    if grain:
        per_key = per_key.groupBy("is_valid", F.when(valid, F.col("grain"))).agg(
            F.sum("records").alias("records"), F.count("*").alias("keys"), F.lit(1).alias("rows")
        )
    else:
        per_key = per_key.select("is_valid", "records", F.lit(1).alias("keys"), F.lit(1).alias("rows"))

    def total(name: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(name))), F.lit(0)).cast("long")

    return per_key.agg(
        total("records", F.lit(True)).alias("BRONZE"),
        total("keys", valid).alias("SILVER"),
        total("rows", valid).alias("GOLD"),
        total("records", ~valid).alias("QUARANTINE"),
    )


def conservation(counts: DataFrame) -> DataFrame:
    """Reconcile Bronze with Silver.

    ``counts`` has ``bronze_rows``, ``silver_rows`` and ``failure_rows``; an
    unknown failure count leaves the balance PARTIAL.
    """
    bronze, silver, failures = F.col("bronze_rows"), F.col("silver_rows"), F.col("failure_rows")
    removed = bronze - silver
    rest = removed - failures

    def share(part: Column) -> Column:
        return shown(F.try_divide(part.cast("double"), bronze) * F.lit(100.0), 3)

    known = bronze.isNotNull() & silver.isNotNull()
    state = (
        F.when(~known, "UNKNOWN")
        .when(removed < 0, "CHECK")
        .when(failures.isNull(), "PARTIAL")
        .when(rest < 0, "CHECK")
        .otherwise("BALANCED")
    )
    return counts.withColumns(
        {
            "removed_before_silver": F.when(known, removed),
            "conservation_state": state,
            "silver_retention_pct": F.when(known, share(silver)),
            "quality_failure_pct": F.when(known, share(failures)),
        }
    ).withColumn(
        "deduplicated_rows", F.when(F.col("conservation_state") == "BALANCED", rest)
    )


def quality_snapshot(counts: DataFrame) -> DataFrame:
    """One-row snapshot from ``layer_counts``.

    ``not_routed_rows`` are Bronze rows no Silver table takes; they are part of
    ``deduplicated_rows`` in the conservation formula and shown beside it.
    """

    def total(layer: str) -> Column:
        return F.sum(F.when(F.col("layer") == layer, F.col("rows")))

    summed = counts.agg(
        total("BRONZE").alias("bronze_rows"),
        total("SILVER").alias("silver_rows"),
        total("GOLD").alias("gold_rows"),
        total("QUARANTINE").alias("failure_rows"),
        total("NOT_ROUTED").alias("not_routed_rows"),
    )
    state = F.col("conservation_state")
    return conservation(summed).withColumn(
        "status",
        F.when(state == "UNKNOWN", "UNKNOWN").when(state == "CHECK", "CHECK").otherwise("MEASURED"),
    )


@dataclass(frozen=True)
class ModelTests:
    """The declared tests of one model: columns without NULL, unique keys, accepted values."""

    model: str
    not_null: tuple[str, ...] = ()
    unique: str | None = None
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def row_tests(self) -> list[tuple[str, Column]]:
        """Tests that one row decides, by name."""
        return [
            *[(f"not_null:{name}", F.col(name).isNull()) for name in self.not_null],
            *[(f"accepted_values:{name}", ~F.col(name).isin(*values)) for name, values in self.accepted],
        ]


def generic_tests(frame: DataFrame, *declared: ModelTests) -> DataFrame:
    """Violations of all tests of models that share a frame, from one pass over it.

    Row tests are summed per value of the unique key on the way, so that a key that
    occurs more than once is counted by the same shuffle. NULL keys break no uniqueness.
    """
    tests = [(t.model, name, broken) for t in declared for name, broken in t.row_tests()]
    keys = [(t.model, t.unique) for t in declared if t.unique]
    if len(keys) > 1:
        raise ValueError("one unique key at a time")
    counts = [F.count_if(broken).alias(f"t{at}") for at, (_, _, broken) in enumerate(tests)]
    totals = [F.coalesce(F.sum(f"t{at}"), F.lit(0)).alias(f"t{at}") for at in range(len(tests))]
    if keys:
        key = F.col(keys[0][1])
        frame = frame.groupBy(key.alias("key")).agg(F.count("*").alias("n"), *counts)
        repeated = F.col("key").isNotNull() & (F.col("n") > 1)
        counted = frame.agg(*totals, F.count_if(repeated).alias(f"t{len(tests)}"))
    else:
        counted = frame.agg(*counts)
    named = [(m, name) for m, name, _ in tests] + [(m, f"unique:{column}") for m, column in keys]
    results = F.array(
        *[
            F.struct(F.lit(model).alias("model"), F.lit(test).alias("test"), F.col(f"t{at}").alias("failures"))
            for at, (model, test) in enumerate(named)
        ]
    )
    return counted.select(F.inline(results))


def singular_tests(
    grid: DataFrame, performance: DataFrame, cities: DataFrame, types: DataFrame
) -> DataFrame:
    """The four whole-model assertions as violation counts."""
    negative = reduce(
        lambda a, b: a | b,
        [
            F.col(name) < 0
            for name in (
                "station_count",
                "level1_ports",
                "level2_ports",
                "dc_fast_ports",
                "total_known_ports",
            )
        ],
    )
    coverage = F.col("forecast_coverage_pct")
    error, computed = F.col("demand_forecast_error_mwh"), F.col("demand_mwh") - F.col(
        "demand_forecast_mwh"
    )
    wrong_error = computed.isNotNull() & (error.isNull() | (F.abs(error - computed) > 1e-6))
    aggregates = performance.join(types.select("respondent"), "respondent", "left_semi")

    def result(name: str, frame: DataFrame) -> DataFrame:
        return frame.agg(F.count("*").alias("failures")).select(F.lit(name).alias("test"), "failures")

    return reduce(
        DataFrame.unionByName,
        [
            result("ev_metrics_nonnegative", cities.where(negative)),
            result("forecast_coverage_bounds", performance.where(~coverage.between(0, 100))),
            result("grid_forecast_error_math", grid.where(wrong_error)),
            result("no_aggregates_in_authorities", aggregates),
        ],
    )


def platform_status(
    grid: DataFrame, performance: DataFrame, cities: DataFrame, weather: DataFrame
) -> DataFrame:
    """Row counts of the four served marts as one row."""
    tables = {
        "grid_hourly_rows": grid,
        "balancing_authorities": performance,
        "ev_cities": cities,
        "weather_forecasts": weather,
    }
    counted = reduce(
        DataFrame.unionByName,
        [
            frame.agg(F.count("*").alias("rows")).withColumn("table", F.lit(name))
            for name, frame in tables.items()
        ],
    )
    return counted.agg(
        *[F.max(F.when(F.col("table") == name, F.col("rows"))).alias(name) for name in tables]
    )
