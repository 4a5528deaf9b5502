"""State of every node and edge of the data flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperline.operators.incidents import severity_rank
from amperline.operators.runs import stage_sla, stage_telemetry

# Nodes as (id, label, layer, technology, kind, reference). The
# reference is the source, component or stage whose state the node shows.
NODES = (
    ("source-eia", "EIA", "SOURCE", "Public API", "source", "eia"),
    ("source-nws", "NWS", "SOURCE", "Public API", "source", "nws"),
    ("source-afdc", "AFDC", "SOURCE", "Public API", "source", "afdc"),
    ("kafka", "Kafka", "STREAMING", "Apache Kafka", "component", "kafka"),
    ("spark-bronze", "Bronze", "LAKEHOUSE", "Spark", "stage", "kafka_to_bronze"),
    ("spark-silver", "Silver", "LAKEHOUSE", "Spark", "stage", "bronze_to_silver"),
    ("spark-gold", "Gold", "ANALYTICS", "Spark", "stage", "build_gold"),
    ("dbt", "dbt", "MODELING", "dbt", "stage", "dbt_build"),
    ("duckdb", "DuckDB", "WAREHOUSE", "DuckDB", "component", "warehouse"),
    ("fastapi", "FastAPI", "SERVING", "FastAPI", "dependent", "warehouse"),
    ("nextjs", "Next.js", "EXPERIENCE", "Next.js", "dependent", "warehouse"),
)
# Edges as (id, from, to, label).
EDGES = (
    ("eia-kafka", "source-eia", "kafka", "grid events"),
    ("nws-kafka", "source-nws", "kafka", "forecast events"),
    ("afdc-kafka", "source-afdc", "kafka", "station events"),
    ("kafka-bronze", "kafka", "spark-bronze", "stream"),
    ("bronze-silver", "spark-bronze", "spark-silver", "transform"),
    ("silver-gold", "spark-silver", "spark-gold", "aggregate"),
    ("gold-dbt", "spark-gold", "dbt", "model"),
    ("dbt-duckdb", "dbt", "duckdb", "serve"),
    ("duckdb-api", "duckdb", "fastapi", "query"),
    ("api-ui", "fastapi", "nextjs", "JSON API"),
)
STATE_RANK = {"UNKNOWN": 0, "HEALTHY": 1, "DEGRADED": 2, "UNHEALTHY": 3}
FRESHNESS_TO_STATE = {"FRESH": "HEALTHY", "DELAYED": "DEGRADED", "STALE": "UNHEALTHY"}
RUNTIME_TO_STATE = {"healthy": "HEALTHY", "degraded": "DEGRADED", "unhealthy": "UNHEALTHY"}
SLA_TO_STATE = {
    "FAILED": "UNHEALTHY",
    "STALLED": "UNHEALTHY",
    "OVERDUE": "DEGRADED",
    "RUNNING": "HEALTHY",
    "SUCCEEDED": "HEALTHY",
}


def mapped(value: Column, states: dict[str, str]) -> Column:
    """Translate a state; anything else, NULL included, is UNKNOWN."""
    table = F.create_map(*[F.lit(item) for pair in states.items() for item in pair])
    return F.coalesce(F.try_element_at(table, value), F.lit("UNKNOWN"))


def worst_state(states: DataFrame, column: str = "state") -> DataFrame:
    """Most severe of several node states; UNKNOWN without rows."""
    ranks = F.create_map(*[F.lit(item) for pair in STATE_RANK.items() for item in pair])
    rank = F.coalesce(F.try_element_at(ranks, F.col(column)), F.lit(0))
    return states.agg(F.coalesce(F.max_by(column, rank), F.lit("UNKNOWN")).alias("worst_state"))


def _source_states(signals: DataFrame) -> DataFrame:
    age = F.when(
        F.col("age_hours").isNotNull(), F.format_string("%.1fh old", "age_hours")
    ).otherwise("unknown age")
    return signals.select(
        F.lit("source").alias("kind"),
        F.col("source").alias("reference"),
        mapped(F.col("state"), FRESHNESS_TO_STATE).alias("own_state"),
        F.concat_ws(" · ", "state", age, "timestamp_basis").alias("own_detail"),
    )


def _component_states(components: DataFrame, kind: str) -> DataFrame:
    return components.select(
        F.lit(kind).alias("kind"),
        F.col("name").alias("reference"),
        mapped(F.lower(F.trim("status")), RUNTIME_TO_STATE).alias("own_state"),
        (F.col("detail") if kind == "component" else F.lit("Follows the warehouse.")).alias(
            "own_detail"
        ),
    )


def lineage_nodes(
    signals: DataFrame, components: DataFrame, incidents: DataFrame, runs: DataFrame, now
) -> DataFrame:
    """The eleven nodes with their state, run telemetry and active incident.

    A stage shows the verdict on its own runs; upstream trouble stays visible on
    the upstream nodes.
    """
    spark = signals.sparkSession
    nodes = spark.createDataFrame(
        NODES,
        "node_id STRING, label STRING, layer STRING, technology STRING, kind STRING, "
        "reference STRING",
    )
    sla = stage_sla(runs, now).select(
        "stage",
        F.col("status").alias("operational_status"),
        "current_runtime_seconds",
        "expected_max_runtime_seconds",
        "runtime_threshold_basis",
        "success_age_hours",
        "max_success_age_hours",
        F.col("detail").alias("sla_detail"),
    )
    stages = sla.join(stage_telemetry(runs), "stage", "left").withColumns(
        {"kind": F.lit("stage"), "reference": F.col("stage")}
    )
    states = (
        _source_states(signals)
        .unionByName(_component_states(components, "component"))
        .unionByName(_component_states(components, "dependent"))
        .unionByName(
            stages.select(
                "kind",
                "reference",
                mapped(F.col("operational_status"), SLA_TO_STATE).alias("own_state"),
                F.col("sla_detail").alias("own_detail"),
            )
        )
    )
    top_incident = incidents.groupBy(F.col("source").alias("reference")).agg(
        F.min_by(
            "title", F.struct(-severity_rank(F.col("severity")), F.col("incident_id"))
        ).alias("title")
    )
    incident_of = top_incident.select(
        F.explode(F.array(F.lit("source"), F.lit("component"))).alias("kind"), "reference", "title"
    )
    suffix = F.coalesce(
        F.concat(F.lit(" Active incident: "), F.col("title"), F.lit(".")), F.lit("")
    )
    return (
        nodes.join(states, ["kind", "reference"], "left")
        .join(incident_of, ["kind", "reference"], "left")
        .join(stages, ["kind", "reference"], "left")
        .select(
            "node_id",
            "label",
            "layer",
            "technology",
            F.coalesce("own_state", F.lit("UNKNOWN")).alias("state"),
            F.concat(F.coalesce("own_detail", F.lit("State unavailable.")), suffix).alias("detail"),
            F.when(F.col("kind").isin("source", "component"), F.col("reference")).alias("source"),
            F.col("stage").alias("run_stage"),
            F.col("latest_status").alias("latest_run_status"),
            F.col("latest_started_at").alias("latest_run_started_at"),
            F.col("latest_finished_at").alias("latest_run_finished_at"),
            F.col("latest_duration_seconds").alias("latest_run_duration_seconds"),
            "last_success_at",
            F.coalesce("recent_runs", F.lit(0)).alias("recent_runs"),
            F.coalesce("recent_failures", F.lit(0)).alias("recent_failures"),
            "latest_records_processed",
            "latest_throughput_records_per_second",
            "operational_status",
            "current_runtime_seconds",
            "expected_max_runtime_seconds",
            "runtime_threshold_basis",
            "success_age_hours",
            "max_success_age_hours",
            "sla_detail",
        )
    )


def lineage_edges(nodes: DataFrame) -> DataFrame:
    """The ten edges with the states of both ends."""
    edges = nodes.sparkSession.createDataFrame(
        EDGES, "edge_id STRING, source_node STRING, target_node STRING, label STRING"
    )

    def end(prefix: str) -> DataFrame:
        return nodes.select(
            F.col("node_id").alias(f"{prefix}_node"), F.col("state").alias(f"{prefix}_state")
        )

    return edges.join(end("source"), "source_node", "left").join(end("target"), "target_node", "left")


def lineage_counts(nodes: DataFrame) -> DataFrame:
    """Headline counts over the node table."""
    return nodes.agg(
        F.count("*").alias("nodes"),
        F.count_if(F.col("state") == "HEALTHY").alias("healthy"),
        F.count_if(F.col("state") == "DEGRADED").alias("degraded"),
        F.count_if(F.col("state") == "UNHEALTHY").alias("unhealthy"),
        F.count_if(F.col("latest_run_status").isNotNull()).alias("instrumented"),
    )
