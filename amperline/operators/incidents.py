"""Operational incidents from freshness signals and component states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Severity order.
SEVERITY_RANK = {"CRITICAL": 4, "HIGH": 3, "ELEVATED": 2, "NORMAL": 1}

ACTIONS = {
    "STALE": "Check ingestion and the provider before trusting results built on this source.",
    "DELAYED": "Watch the next ingestion cycle and confirm the delay is not growing.",
    "UNKNOWN": "Confirm the mart exists and has one of the supported timestamp columns.",
    "unhealthy": "Investigate the failed dependency now and check what depends on it.",
    "degraded": "Investigate the slow dependency before it becomes an outage.",
    "other": "Check health reporting and confirm the component's real state.",
}


def severity_rank(severity: Column) -> Column:
    ranks = F.create_map(*[F.lit(item) for pair in SEVERITY_RANK.items() for item in pair])
    return F.coalesce(F.try_element_at(ranks, severity), F.lit(0))


def _by(key: Column, choices: dict[str, str], default: str) -> Column:
    """Text chosen by a key column."""
    chosen = F.lit(default)
    for name, text in choices.items():
        chosen = F.when(key == name, F.lit(text)).otherwise(chosen)
    return chosen


def freshness_incidents(signals: DataFrame) -> DataFrame:
    """One incident for every source that is not fresh."""
    state = F.when(F.col("state").isin("STALE", "DELAYED"), F.col("state")).otherwise("UNKNOWN")
    age = F.when(
        F.col("age_hours").isNotNull(), F.format_string("%.1fh old", "age_hours")
    ).otherwise("age unavailable")
    basis = F.format_string("Basis: %s.", "timestamp_basis")
    late = F.format_string(
        "Latest signal is %s. %s is %.0fh. %s",
        age,
        _by(state, {"STALE": "Stale threshold"}, "Freshness target"),
        F.when(state == "STALE", F.col("stale_after_hours")).otherwise(
            F.col("fresh_within_hours")
        ),
        basis,
    )
    unknown = F.concat(F.lit("No usable freshness timestamp. "), basis)
    return signals.where(F.col("state") != "FRESH").select(
        F.concat_ws(":", F.lit("source"), "source", F.lower(state)).alias("incident_id"),
        _by(state, {"STALE": "HIGH"}, "ELEVATED").alias("severity"),
        F.lit("DATA_FRESHNESS").alias("category"),
        F.concat(
            "display_name",
            _by(
                state,
                {"STALE": " source is stale", "DELAYED": " source is delayed"},
                " freshness is unknown",
            ),
        ).alias("title"),
        "source",
        state.alias("current_state"),
        F.when(state == "UNKNOWN", unknown).otherwise(late).alias("evidence"),
        _by(
            state,
            {name: ACTIONS[name] for name in ("STALE", "DELAYED")},
            ACTIONS["UNKNOWN"],
        ).alias("recommended_action"),
    )


def component_incidents(components: DataFrame) -> DataFrame:
    """One incident for every component that is not healthy."""
    status = F.lower(F.trim("status"))
    shown = F.initcap(F.regexp_replace("name", "_", " "))
    return components.where(status != "healthy").select(
        F.concat_ws(":", F.lit("component"), "name", status).alias("incident_id"),
        _by(status, {"unhealthy": "CRITICAL", "degraded": "HIGH"}, "ELEVATED").alias("severity"),
        F.lit("PLATFORM_RUNTIME").alias("category"),
        F.format_string("%s is %s", shown, status).alias("title"),
        F.col("name").alias("source"),
        F.upper(status).alias("current_state"),
        F.format_string("%s Observed latency: %.1f ms.", "detail", "latency_ms").alias("evidence"),
        _by(
            status,
            {name: ACTIONS[name] for name in ("unhealthy", "degraded")},
            ACTIONS["other"],
        ).alias("recommended_action"),
    )


def operational_incidents(signals: DataFrame, components: DataFrame) -> DataFrame:
    """All incidents, most severe first."""
    return (
        freshness_incidents(signals)
        .unionByName(component_incidents(components))
        .orderBy(severity_rank(F.col("severity")).desc(), "incident_id")
    )


def highest_severity(incidents: DataFrame) -> DataFrame:
    """Most severe level present; NORMAL without incidents."""
    top = F.max_by("severity", severity_rank(F.col("severity")))
    return incidents.agg(F.coalesce(top, F.lit("NORMAL")).alias("highest_severity"))


def component_health(components: DataFrame) -> DataFrame:
    """Healthy components, all components, and the state of the platform."""
    status = F.lower(F.trim("status"))
    return components.agg(
        F.count_if(status == "healthy").alias("healthy_components"),
        F.count("*").alias("components"),
        F.when(F.count_if(status == "unhealthy") > 0, "unhealthy")
        .when(F.count_if(status == "degraded") > 0, "degraded")
        .otherwise("healthy")
        .alias("platform_state"),
    )
