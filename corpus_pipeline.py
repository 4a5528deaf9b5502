"""A corpus pipeline: each stage works on all rows that the one before kept, stored in between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.llm.common import table, unused
from amperline.llm.containment import decontaminate
from amperline.llm.jaccard import keep_one_of_each
from amperline.llm.mixing import mix
from amperline.llm.templates import drop_recurring_lines
from amperline.llm.toxicity import drop_toxic
from amperline.session import durable


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines of recurring templates; n_chars follows the text."""
    lines, dropped = unused(docs.columns, "_lines", "_dropped")
    cleaned = drop_recurring_lines(docs, into=(lines, dropped))
    length = F.when(F.col(dropped) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length).drop(lines, dropped)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest id."""
    return keep_one_of_each(docs)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mixture of sources gives out: documents with epoch, order keys and weight in place of columns so named."""
    return mix(docs, into=("epoch", "block_order", "doc_order", "weight"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_recurring_lines),
    ("near_duplicates", one_of_each),
    ("decontamination", without_test_items),
    ("mixing", mixed_sources),
]

#: The classifier and the MinHash searches have no SQL; tests/llm compares the stages with brute force on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents, each result written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
