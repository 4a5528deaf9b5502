"""Incremental windows, period coverage and the control watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperline.functions.clock import instant
from amperline.session import durable
from amperline.sources.control import ControlTable


def hours(count: Column | int) -> Column:
    return F.make_interval(hours=F.lit(count) if isinstance(count, int) else count)


def next_window(
    state: DataFrame,
    now,
    bootstrap_start,
    safety_lag_hours: int = 2,
    max_window_hours: int | None = None,
) -> DataFrame:
    """Next period window per control row; no row when it is up to date.

    ``state`` has a ``watermark`` column, NULL before the first run.
    """
    if safety_lag_hours < 0:
        raise ValueError("safety_lag_hours must be zero or greater")
    if max_window_hours is not None and max_window_hours < 1:
        raise ValueError("max_window_hours must be greater than zero")
    safe = F.date_trunc("hour", instant(now) - hours(safety_lag_hours))
    planned = state.withColumn(
        "window_start", F.coalesce(F.col("watermark") + hours(1), instant(bootstrap_start))
    ).withColumn("window_end", safe)
    planned = planned.where(F.col("window_start") <= F.col("window_end"))
    if max_window_hours is not None:
        capped = F.col("window_start") + hours(max_window_hours - 1)
        planned = planned.withColumn("window_end", F.least("window_end", capped))
    seconds = F.unix_timestamp("window_end") - F.unix_timestamp("window_start")
    return planned.withColumn("hour_count", F.floor(seconds / 3600) + 1)


def expected_periods(windows: DataFrame) -> DataFrame:
    """One row per hour of each window."""
    return windows.withColumn(
        "period", F.explode(F.sequence("window_start", "window_end", F.expr("INTERVAL 1 HOUR")))
    )


def coverage_gaps(windows: DataFrame, received: DataFrame, keys: list[str]) -> DataFrame:
    """Expected periods that were not received."""
    arrived = received.select(*keys, "period").distinct()
    return expected_periods(windows).select(*keys, "period").join(
        arrived, [*keys, "period"], "left_anti"
    )


def advance(windows: DataFrame, received: DataFrame, keys: list[str]) -> DataFrame:
    """Next watermark per control row; kept back while any hour is missing."""
    missing = (
        coverage_gaps(windows, received, keys).groupBy(*keys).agg(F.count("*").alias("missing"))
    )
    return windows.join(missing, keys, "left").select(
        *keys,
        F.coalesce("missing", F.lit(0)).alias("missing_hours"),
        F.when(F.col("missing").isNull(), F.col("window_end"))
        .otherwise(F.col("watermark"))
        .alias("watermark"),
    )


def advance_control(
    table: ControlTable,
    keys: list[str],
    received: DataFrame,
    now,
    bootstrap_start,
    *,
    safety_lag_hours: int = 2,
    max_window_hours: int | None = None,
) -> DataFrame:
    """Plan the next window from the stored watermarks, check its coverage and store what advanced.

    The state is read at one version and committed on that version, so that of two runs
    at the same time one fails and leaves no trace. A window with a missing hour, and a
    key that is up to date, keep their watermark; if none advances, no version is
    written. Returns the window of every planned key, with the version that is in force.
    """
    version, state = table.read()
    windows = next_window(state, now, bootstrap_start, safety_lag_hours, max_window_hours)
    report = durable(
        windows.withColumnRenamed("watermark", "watermark_before")
        .join(advance(windows, received, keys), keys)
        .select(*keys, "watermark_before", "window_start", "window_end", "missing_hours", "watermark")
    )
    moved = report.where("missing_hours = 0").select(*keys, F.col("watermark").alias("moved"))
    if not moved.isEmpty():
        kept = state.join(moved, keys, "left").withColumn("watermark", F.coalesce("moved", "watermark"))
        version = table.commit(kept.drop("moved"), version)
    return report.withColumn("version", F.lit(version))
