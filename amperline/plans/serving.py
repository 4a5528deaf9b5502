"""The served questions with their parameter bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.operators import runs as run_operators
from amperline.operators import scoring

# Accepted parameter ranges.
BOUNDS = {
    "anomalies": (1, 100),
    "regions": (1, 50),
    "hours": (24, 720),
    "authorities": (1, 100),
    "cities": (1, 100),
    "weather": (1, 168),
    "runs": (1, 200),
}


def bounded(name: str, value: int) -> int:
    low, high = BOUNDS[name]
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}")
    return value


def anomalies(grid: DataFrame, limit: int = 20) -> DataFrame:
    return scoring.grid_anomalies(grid, bounded("anomalies", limit))


def regions(grid: DataFrame, limit: int = 20) -> DataFrame:
    return scoring.regional_signals(grid, bounded("regions", limit))


def region_history(grid: DataFrame, region: str, hours: int = 168) -> DataFrame:
    return scoring.regional_history(grid, region, bounded("hours", hours))


def timeline(grid: DataFrame, hours: int = 168) -> DataFrame:
    return scoring.regional_timeline(grid, bounded("hours", hours))


def authorities(performance: DataFrame, limit: int = 20) -> DataFrame:
    """Authorities by peak demand rank."""
    return performance.orderBy("peak_demand_rank", "respondent").limit(
        bounded("authorities", limit)
    )


def cities(rankings: DataFrame, state: str | None = None, limit: int = 25) -> DataFrame:
    """Cities by national rank, optionally of one two-letter state."""
    if state is not None:
        if len(state) != 2:
            raise ValueError("state must have two letters")
        rankings = rankings.where(F.upper("state") == state.upper())
    return rankings.orderBy("national_station_rank", "state", "city").limit(
        bounded("cities", limit)
    )


def weather(forecast: DataFrame, limit: int = 24) -> DataFrame:
    """Forecast hours by location and start."""
    return forecast.orderBy("location_key", "period_start").limit(bounded("weather", limit))


def recent_runs(states: DataFrame, limit: int = 50) -> DataFrame:
    return run_operators.latest_runs(states, bounded("runs", limit))
