"""Grid risk, regional pressure, history and timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amperline.functions.numeric import (
    MIN_HISTORY_POINTS,
    PRESSURE_WEIGHTS,
    RISK_WEIGHTS,
    change_pct,
    gap_pct,
    robust_score,
    severity,
    shown,
    weighted_score,
)
from amperline.operators.baseline import baselines
from amperline.session import durable

COMPONENTS = {
    "demand": "demand_mwh",
    "forecast": "forecast_error_pct",
    "generation": "generation_gap_pct",
}


def observations(grid: DataFrame, entity_type: str) -> DataFrame:
    """Rows of one entity type with positive demand and the scored measures."""
    return grid.where((F.col("entity_type") == entity_type) & (F.col("demand_mwh") > 0)).select(
        "period",
        "respondent",
        F.coalesce("respondent_name", "respondent").alias("respondent_name"),
        "demand_mwh",
        "demand_forecast_mwh",
        "net_generation_mwh",
        "total_interchange_mwh",
        F.col("demand_forecast_error_pct").alias("signed_error_pct"),
        F.abs("demand_forecast_error_pct").alias("forecast_error_pct"),
        gap_pct(F.col("generation_demand_gap_mwh"), F.col("demand_mwh")).alias(
            "generation_gap_pct"
        ),
        "contains_replay",
    )


def newest_rows(base: DataFrame, points: int) -> DataFrame:
    """The newest ``points`` rows per respondent; ``recency`` 1 is the newest.

    The rank filter is pushed below the shuffle, so each map task passes on at
    most ``points`` rows of a respondent.
    """
    order = Window.partitionBy("respondent").orderBy(
        F.col("period").desc(), F.col("respondent_name").desc()
    )
    return durable(
        base.withColumn("recency", F.row_number().over(order)).where(F.col("recency") <= points)
    )


def _long(rows: DataFrame, components: tuple[str, ...], *extra: str) -> DataFrame:
    """One row per component value."""
    wide = rows.select(
        F.col("respondent").alias("series"),
        *extra,
        *[F.col(COMPONENTS[name]).alias(name) for name in components],
    )
    return wide.unpivot(["series", *extra], list(components), "component", "value")


def with_baselines(
    base: DataFrame,
    newest: DataFrame,
    points: int,
    components: tuple[str, ...],
    *,
    strictly_earlier_period: bool = False,
) -> DataFrame:
    """Add ``<component>_{points,median,mad,mean,stddev}`` to the newest rows.

    ``newest`` are the rows with ``recency`` up to ``points``; their history is
    every older row of the same respondent.
    """
    position = F.struct("period", "respondent_name")
    oldest = newest.groupBy("respondent").agg(F.min(position).alias("oldest"))
    older = (
        F.col("period") < F.col("oldest.period")
        if strictly_earlier_period
        else position < F.col("oldest")
    )
    history = _long(
        base.join(oldest, "respondent").where(older), components
    ).where(F.col("value").isNotNull())
    found = baselines(_long(newest, components, "recency"), history, points)
    fields = ("points", "median", "mad", "mean", "stddev")
    wide = found.groupBy(F.col("series").alias("respondent"), "recency").agg(
        *[
            F.max(F.when(F.col("component") == name, F.col(field))).alias(f"{name}_{field}")
            for name in components
            for field in fields
        ]
    )
    return newest.join(wide, ["respondent", "recency"])


def _score(name: str, **options: bool) -> Column:
    return robust_score(
        F.col(COMPONENTS[name]),
        *[F.col(f"{name}_{field}") for field in ("points", "median", "mad", "mean", "stddev")],
        **options,
    )


def grid_anomalies(grid: DataFrame, limit: int = 100) -> DataFrame:
    """Newest observation of every authority scored against its own past."""
    base = observations(grid, "balancing_authority").where(
        (F.col("demand_forecast_mwh") > 0) & F.col("signed_error_pct").isNotNull()
    )
    scored = with_baselines(
        base, newest_rows(base, 1), 1, ("forecast", "generation"), strictly_earlier_period=True
    ).where(F.col("forecast_points") >= MIN_HISTORY_POINTS)
    scores = {name: _score(name) for name in RISK_WEIGHTS}
    risk = weighted_score(RISK_WEIGHTS, scores)
    return (
        scored.withColumn("risk", risk)
        .orderBy(F.col("risk").desc(), F.col("period").desc(), "respondent")
        .limit(limit)
        .select(
            "period",
            "respondent",
            "respondent_name",
            "demand_mwh",
            "demand_forecast_mwh",
            F.col("signed_error_pct").alias("forecast_error_pct"),
            "generation_gap_pct",
            F.col("forecast_points").alias("history_points"),
            F.col("forecast_median").alias("forecast_baseline_pct"),
            shown(scores["forecast"], 2).alias("forecast_deviation_score"),
            F.col("generation_median").alias("generation_baseline_pct"),
            shown(scores["generation"], 2).alias("generation_deviation_score"),
            shown("risk", 1).alias("risk_score"),
            severity(F.col("risk")).alias("severity"),
        )
    )


def _regional_columns(scores: dict[str, Column], baseline: Column) -> list:
    """Shared output of the regional signal and the regional timeline."""
    demand, median = F.col("demand_mwh"), F.col("demand_median")
    versus = F.coalesce(
        F.try_divide((demand - median) * F.lit(100.0), median), F.lit(0.0)
    )
    pressure = weighted_score(PRESSURE_WEIGHTS, scores)
    return [
        "period",
        F.col("respondent").alias("region"),
        F.col("respondent_name").alias("region_name"),
        "demand_mwh",
        "demand_forecast_mwh",
        "net_generation_mwh",
        "total_interchange_mwh",
        baseline.alias("demand_baseline_mwh"),
        shown(versus, 2).alias("demand_vs_baseline_pct"),
        shown(change_pct(demand, F.col("previous_demand")), 2).alias("demand_change_pct"),
        "forecast_error_pct",
        "generation_gap_pct",
        F.col("demand_points").alias("history_points"),
        *[shown(scores[name], 2).alias(f"{name}_deviation_score") for name in COMPONENTS],
        shown(pressure, 1).alias("pressure_score"),
        severity(pressure).alias("severity"),
    ]


def _with_previous_demand(rows: DataFrame) -> DataFrame:
    """Demand one row earlier, from the already bounded newest rows."""
    order = Window.partitionBy("respondent").orderBy(F.col("recency").desc())
    return rows.withColumn("previous_demand", F.lag("demand_mwh").over(order))


def regional_signals(grid: DataFrame, limit: int = 25) -> DataFrame:
    """Newest load state of every region scored against its own past."""
    base = observations(grid, "region")
    newest = durable(_with_previous_demand(newest_rows(base, 2)).where("recency = 1"))
    scored = with_baselines(
        base, newest, 1, tuple(COMPONENTS), strictly_earlier_period=True
    ).where(F.col("demand_points") >= MIN_HISTORY_POINTS)
    scores = {name: _score(name, high_only=name == "demand") for name in COMPONENTS}
    median = F.col("demand_median")
    versus = F.try_divide((F.col("demand_mwh") - median) * F.lit(100.0), median)
    return (
        scored.withColumns({"raw": weighted_score(PRESSURE_WEIGHTS, scores), "versus": versus})
        .orderBy(F.col("raw").desc(), F.col("versus").desc_nulls_last(), "respondent")
        .limit(limit)
        .select(*_regional_columns(scores, median))
    )


def regional_timeline(grid: DataFrame, hours: int = 168) -> DataFrame:
    """Newest ``hours`` points of every region, each scored without look-ahead."""
    base = observations(grid, "region")
    window = durable(_with_previous_demand(newest_rows(base, hours + 1)))
    newest = window.where(F.col("recency") <= hours)
    scored = with_baselines(base, newest, hours, tuple(COMPONENTS)).where(
        F.col("demand_points") >= MIN_HISTORY_POINTS
    )
    scores = {
        name: _score(name, high_only=name == "demand", clamp_low=True) for name in COMPONENTS
    }
    return scored.select(
        *_regional_columns(scores, shown("demand_median", 2)),
        F.coalesce("contains_replay", F.lit(False)).alias("contains_replay"),
    ).orderBy("period", "region")


def regional_history(grid: DataFrame, region: str, hours: int = 168) -> DataFrame:
    """Newest ``hours`` points of one region with an expanding median baseline."""
    wanted = region.strip().upper()
    base = observations(grid, "region").where(
        (F.col("respondent") == wanted) & F.lit(bool(wanted))
    )
    window = durable(_with_previous_demand(newest_rows(base, hours + 1)))
    rows = with_baselines(base, window.where(F.col("recency") <= hours), hours, ("demand",))
    demand, median = F.col("demand_mwh"), F.col("demand_median")
    return rows.select(
        "period",
        F.col("respondent").alias("region"),
        F.col("respondent_name").alias("region_name"),
        "demand_mwh",
        "demand_forecast_mwh",
        "net_generation_mwh",
        "total_interchange_mwh",
        median.alias("demand_baseline_mwh"),
        change_pct(demand, median).alias("demand_vs_baseline_pct"),
        change_pct(demand, F.col("previous_demand")).alias("demand_change_pct"),
        "forecast_error_pct",
        "generation_gap_pct",
        F.coalesce("contains_replay", F.lit(False)).alias("contains_replay"),
    ).orderBy("period")


def history_summary(history: DataFrame) -> DataFrame:
    """Average, peak and minimum demand and the number of replayed points."""
    return history.agg(
        F.avg("demand_mwh").alias("average_demand_mwh"),
        F.max("demand_mwh").alias("peak_demand_mwh"),
        F.min("demand_mwh").alias("minimum_demand_mwh"),
        F.count_if("contains_replay").alias("replay_points"),
    )


def severity_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("severity").agg(F.count("*").alias("entities"))


def timeline_periods(timeline: DataFrame) -> DataFrame:
    """The frames of a timeline in order."""
    return timeline.select("period").distinct().orderBy("period")


def timeline_frame(timeline: DataFrame, period) -> DataFrame:
    """All regions of one frame."""
    return timeline.where(F.col("period") == period).orderBy("region")


def peer_regions(signals: DataFrame, region: str, limit: int = 6) -> DataFrame:
    """Highest-pressure regions other than the chosen one."""
    return (
        signals.where(F.col("region") != region)
        .orderBy(F.col("pressure_score").desc(), "region")
        .limit(limit)
    )
