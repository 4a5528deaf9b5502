"""Stage runs: latest state, summaries, telemetry and runtime targets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amperline.functions.clock import hours_between, instant, seconds_between
from amperline.functions.numeric import shown
from amperline.operators.baseline import exact_median

RUN_COLUMNS = (
    "run_id",
    "stage",
    "status",
    "started_at",
    "finished_at",
    "duration_seconds",
    "exit_code",
    "records_processed",
    "throughput_records_per_second",
    "command",
)
COUNT_MARKER = r"RECORDS_PROCESSED=(\d+)"


@dataclass(frozen=True)
class StageTarget:
    stage: str
    display_name: str
    fallback_seconds: float
    max_success_age_hours: float


# Stages and their runtime and success-age targets.
STAGE_TARGETS = (
    StageTarget("kafka_to_bronze", "Kafka → Bronze", 300.0, 24.0),
    StageTarget("bronze_to_silver", "Bronze → Silver", 600.0, 24.0),
    StageTarget("build_gold", "Gold Analytics Build", 600.0, 24.0),
    StageTarget("dbt_build", "dbt Analytics Build", 600.0, 24.0),
)
MIN_RUNS_FOR_LEARNED_LIMIT = 3
LEARNED_LIMIT_FACTOR = 4.0
LEARNED_LIMIT_BOUNDS = (60.0, 3600.0)


def throughput(records: Column, seconds: Column) -> Column:
    """Records per second; NULL unless both are known and time has passed."""
    return F.when(seconds > 0, shown(records / seconds, 3))


def records_from_marker(line: Column) -> Column:
    """Declared record count in a line of process output, else NULL."""
    found = F.regexp_extract(line, COUNT_MARKER, 1)
    return F.when(found != "", found.cast("long"))


def latest_runs(states: DataFrame, limit: int | None = None) -> DataFrame:
    """Last logged state of each run, newest start first.

    A finished state comes after a started one, and of several the one that
    ended last counts; ``line_no``, the position in a file, only breaks ties.
    """
    last = Window.partitionBy("run_id").orderBy(
        F.col("finished_at").isNotNull().desc(),
        F.coalesce("finished_at", "started_at").desc(),
        F.col("line_no").desc(),
    )
    runs = (
        states.withColumn("recency", F.row_number().over(last))
        .where("recency = 1")
        .select(*RUN_COLUMNS)
    )
    newest = runs.orderBy(F.col("started_at").desc(), "run_id")
    return newest if limit is None else newest.limit(limit)


def _finished(status: str = "SUCCEEDED") -> Column:
    return F.when(F.col("status") == status, F.coalesce("finished_at", "started_at"))


def run_summary(runs: DataFrame) -> DataFrame:
    """Totals by state and the end of the latest successful run."""
    success = F.col("status") == "SUCCEEDED"
    return runs.agg(
        F.count("*").alias("total_runs"),
        F.count_if(F.col("status") == "STARTED").alias("running_runs"),
        F.count_if(F.col("status") == "FAILED").alias("failed_runs"),
        F.count_if(success).alias("successful_runs"),
        F.max_by(F.when(success, F.col("finished_at")), _finished()).alias("last_success_at"),
    )


def stage_telemetry(runs: DataFrame) -> DataFrame:
    """Latest run, last success and counts per stage."""
    latest = F.max_by(
        F.struct(
            "run_id",
            "status",
            "started_at",
            "finished_at",
            "duration_seconds",
            "records_processed",
            "throughput_records_per_second",
        ),
        F.struct("started_at", "run_id"),
    )
    return (
        runs.groupBy("stage")
        .agg(
            latest.alias("latest"),
            F.max(_finished()).alias("last_success_at"),
            F.count("*").alias("recent_runs"),
            F.count_if(F.col("status") == "FAILED").alias("recent_failures"),
            F.count_if(F.col("status") == "SUCCEEDED").alias("recent_successes"),
        )
        .select(
            "stage",
            F.col("latest.run_id").alias("latest_run_id"),
            F.col("latest.status").alias("latest_status"),
            F.col("latest.started_at").alias("latest_started_at"),
            F.col("latest.finished_at").alias("latest_finished_at"),
            F.col("latest.duration_seconds").alias("latest_duration_seconds"),
            "last_success_at",
            "recent_runs",
            "recent_failures",
            "recent_successes",
            F.col("latest.records_processed").alias("latest_records_processed"),
            F.col("latest.throughput_records_per_second").alias(
                "latest_throughput_records_per_second"
            ),
        )
    )


def learned_limits(runs: DataFrame) -> DataFrame:
    """Runtime limit per stage from its successful runs, where there are enough."""
    good = runs.where((F.col("status") == "SUCCEEDED") & (F.col("duration_seconds") > 0))
    low, high = LEARNED_LIMIT_BOUNDS
    limit = F.greatest(
        F.lit(low), F.least(F.lit(high), F.col("median") * F.lit(LEARNED_LIMIT_FACTOR))
    )
    return (
        exact_median(good, "stage", "duration_seconds")
        .where(F.col("n") >= MIN_RUNS_FOR_LEARNED_LIMIT)
        .select("stage", shown(limit, 3).alias("learned_limit"))
    )


def stage_sla(runs: DataFrame, now, targets: tuple[StageTarget, ...] = STAGE_TARGETS) -> DataFrame:
    """Current state of every configured stage against its targets."""
    spark = runs.sparkSession
    rules = spark.createDataFrame(
        [(t.stage, t.display_name, t.fallback_seconds, t.max_success_age_hours) for t in targets],
        "stage STRING, display_name STRING, fallback DOUBLE, max_success_age_hours DOUBLE",
    )
    moment = instant(now)
    status, started = F.col("latest_status"), F.col("latest_started_at")
    facts = (
        rules.join(stage_telemetry(runs), "stage", "left")
        .join(learned_limits(runs), "stage", "left")
        .withColumns(
            {
                "expected_max_runtime_seconds": F.coalesce("learned_limit", "fallback"),
                "runtime_threshold_basis": F.when(
                    F.col("learned_limit").isNotNull(), "observed_median_x4"
                ).otherwise("configured_fallback"),
                "success_age_hours": F.when(
                    F.col("last_success_at").isNotNull(),
                    shown(hours_between(F.col("last_success_at"), moment), 3),
                ),
                "current_runtime_seconds": F.when(
                    status == "STARTED", shown(seconds_between(started, moment), 3)
                ).otherwise(F.col("latest_duration_seconds")),
            }
        )
    )
    overtime = F.col("current_runtime_seconds") > F.col("expected_max_runtime_seconds")
    too_old = F.col("success_age_hours") > F.col("max_success_age_hours")
    verdict = (
        F.when(status.isNull(), "NO_RUN_DATA")
        .when((status == "STARTED") & overtime, "STALLED")
        .when(status == "STARTED", "RUNNING")
        .when(status == "FAILED", "FAILED")
        .when((status == "SUCCEEDED") & too_old, "OVERDUE")
        .when(status == "SUCCEEDED", "SUCCEEDED")
        .otherwise("UNKNOWN")
    )
    detail = {
        "NO_RUN_DATA": "No run of this stage has been logged.",
        "STALLED": "The running execution is over its runtime limit.",
        "RUNNING": "The running execution is inside its runtime limit.",
        "FAILED": "The latest run failed.",
        "OVERDUE": "The latest success is older than the allowed age.",
        "SUCCEEDED": "The latest run finished successfully.",
        "UNKNOWN": "The latest run has a state that is not recognised.",
    }
    texts = F.create_map(*[F.lit(text) for pair in detail.items() for text in pair])
    return facts.withColumn("status", verdict).select(
        "stage",
        "display_name",
        "status",
        F.col("latest_status").alias("latest_run_status"),
        "latest_run_id",
        "current_runtime_seconds",
        "expected_max_runtime_seconds",
        "runtime_threshold_basis",
        "last_success_at",
        "success_age_hours",
        "max_success_age_hours",
        F.coalesce("recent_runs", F.lit(0)).alias("recent_runs"),
        F.coalesce("recent_failures", F.lit(0)).alias("recent_failures"),
        texts[F.col("status")].alias("detail"),
    )
