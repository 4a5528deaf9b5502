"""Append-only run log as JSON lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.functions.parsing import parsed_once
from amperline.operators.runs import throughput
from amperline.sources.schemas import RUN_LOG

# Fields of a line that must be JSON texts.
TEXT_FIELDS = ("run_id", "stage", "status", "started_at")
_TEXT = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a position inside their file.

    Files of one log are read in no certain order, so the position only tells
    lines of equal times apart; the times of the states order the log.
    """
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line")
    )


def _moment(text: str) -> Column:
    return F.try_to_timestamp(text)


def parse_run_log(lines: DataFrame) -> DataFrame:
    """Typed run states; blank, malformed and incomplete lines are dropped."""
    # JSON types are lost in parsed columns: a number is no text, a list of numbers no list of texts
    text = [F.col("line").rlike(rf'"{name}"\s*:\s*"') for name in TEXT_FIELDS]
    words = F.col("line").rlike(rf'"command"\s*:\s*\[\s*(?:{_TEXT}\s*(?:,\s*{_TEXT}\s*)*+)?\]')
    typed_as_written = reduce(Column.__and__, [*text, words])
    parsed = lines.where(typed_as_written).select(
        "line_no", parsed_once("line", RUN_LOG).alias("run")
    ).select("line_no", "run.*")
    typed = parsed.withColumns(
        {
            "started_at": _moment("started_at"),
            "finished_at": _moment("finished_at"),
            "throughput_records_per_second": F.coalesce(
                "throughput_records_per_second",
                throughput(F.col("records_processed"), F.col("duration_seconds")),
            ),
        }
    )
    complete = [
        F.col(name).isNotNull() for name in ("run_id", "stage", "status", "started_at", "command")
    ]
    no_gaps = ~F.exists("command", lambda part: part.isNull())
    condition = no_gaps
    for check in complete:
        condition = condition & check
    return typed.where(condition)


def run_log_lines(states: DataFrame) -> DataFrame:
    """Run states as JSON lines with sorted keys, for appending."""
    names = sorted(name for name in states.columns if name != "line_no")
    return states.select(
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value")
    )


def append_run_log(states: DataFrame, path: str) -> None:
    run_log_lines(states).write.mode("append").text(path)
