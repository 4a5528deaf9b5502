"""Bronze folders of closed dates merged into one per source and date while streams go on."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from amperline.plans.increments import applied_batches
from amperline.session import durable
from amperline.sources.commits import listed, remove
from amperline.sources.tables import LAYERS, MERGED, merged_batches, read_layer, table_path


def compact_bronze(spark: SparkSession, root: str, before: date, least: int = 2) -> int:
    """Merge the batches of every source and date before ``before`` that has ``least`` of them or more.

    The merged folder is written beside the batches and becomes visible with the new
    version of the manifest, which hides the batches in the same moment; after that
    their folders are removed. A stream that delivers a merged batch once more writes a
    folder that stays hidden. Where Silver is kept by increments, only batches that are
    in it are merged, and the merged folder counts as taken in. Of two merges at a time
    one fails at the manifest and leaves a folder that no reader sees. Returns the
    number of folders replaced.
    """
    layer, folder = LAYERS["bronze_events"], ["source", "kafka_date", "batch_id"]
    bronze = read_layer(spark, root, layer.name)
    if bronze is None:
        raise ValueError("the Bronze table does not exist")
    manifest, applied = merged_batches(spark, root), applied_batches(spark, root)
    version, known = manifest.read()
    closed = bronze.where(F.col("kafka_date") < F.lit(before))
    batches = closed.select(*folder).distinct()
    taken_in, taken = applied.read()
    if taken_in:
        batches = batches.join(taken, "batch_id", "left_semi")
    crowded = batches.groupBy("source", "kafka_date").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    replaced = durable(batches.join(crowded.drop("n"), ["source", "kafka_date"], "left_semi").select(*folder))
    if replaced.isEmpty():
        return 0
    name = f"{MERGED}{uuid.uuid4().hex}"
    (
        closed.join(replaced, folder, "left_semi")
        .withColumn("batch_id", F.lit(name))
        .select(*bronze.columns)
        .hint("rebalance", F.col("source"), F.col("kafka_date"))
        .write.mode("append")
        .partitionBy(*layer.partitions)
        .parquet(table_path(root, layer.name))
    )
    if taken_in:
        applied.commit(taken.unionByName(spark.createDataFrame([(name,)], "batch_id STRING")), taken_in)
    now = known.unionByName(replaced.withColumn("merged_into", F.lit(name)))
    manifest.commit(now, version)
    return _remove_replaced(spark, root)


def _remove_replaced(spark: SparkSession, root: str) -> int:
    """Delete the folders that the manifest has replaced, those of a broken-off removal too."""
    _, merged = merged_batches(spark, root).read()
    base, removed = table_path(root, "bronze_events"), 0
    # one name per folder that is there, and of those only the replaced ones are asked for
    wanted = {(r.source, str(r.kafka_date), r.batch_id) for r in merged.toLocalIterator()}
    for source in listed(spark, base):
        for day in listed(spark, f"{base}/{source}"):
            for batch in listed(spark, f"{base}/{source}/{day}"):
                names = tuple(part.partition("=")[2] for part in (source, day, batch))
                if names in wanted:
                    remove(spark, f"{base}/{source}/{day}/{batch}")
                    removed += 1
    return removed
