"""Silver and Gold kept up to date from new Bronze batches only.

A control table holds the Bronze batches that Silver has taken in. An increment reads
the others, finds the partitions their records touch, merges them with what Silver
holds there and rewrites these partitions of Silver and Gold, and no other file. The
newest record per key is a maximum, so merging it batch by batch gives what a rebuild
over all of Bronze gives, late corrections included.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.operators import typed
from amperline.plans.medallion import GOLD_TABLES, SILVER_TABLES, build_gold, build_silver
from amperline.session import discard, durable, scratch_folder
from amperline.sources.commits import listed, remove
from amperline.sources.control import ControlTable
from amperline.sources.tables import LAYERS, read_layer, table_path, write_layer


def applied_batches(spark: SparkSession, root: str) -> ControlTable:
    """The control table of the Bronze batches that are in Silver."""
    return ControlTable(spark, table_path(root, "applied_batches"), "batch_id STRING")


def _all_batches(spark: SparkSession, root: str) -> DataFrame:
    """Batches of the Bronze table; a partition column, so no file content is read."""
    bronze = read_layer(spark, root, "bronze_events")
    if bronze is None:
        raise ValueError("the Bronze table does not exist")
    return bronze.select("batch_id").distinct()


def rebuild(spark: SparkSession, root: str) -> dict[str, int]:
    """Build Silver and Gold from all of Bronze and note the batches that are in them."""
    table = applied_batches(spark, root)
    version = table.version()
    taken = durable(_all_batches(spark, root))
    written = build_silver(spark, root) | build_gold(spark, root)
    table.commit(taken, version)
    return written


def _touched(new: DataFrame, silver: DataFrame, spec: typed.TypedSource, column: str) -> list:
    """Partitions that the new records are in, or that hold an earlier record of one of their keys.

    Where the partition follows from the key both are the same. Elsewhere (a station
    that moves to another state) the keys of Silver are looked through for it.
    """
    places = new.select(column)
    if not (spec.date_column and spec.date_column[1] in spec.business_key):
        keys = new.select(*spec.business_key).distinct()
        places = places.unionByName(silver.join(keys, list(spec.business_key), "left_semi").select(column))
    return sorted(row[0] for row in places.distinct().collect())


def _drop_emptied(spark: SparkSession, root: str, name: str, touched: list, written: DataFrame) -> None:
    """Remove touched partitions that no row was written to; an overwrite of partitions leaves them."""
    column = LAYERS[name].partitions[0]
    full = {str(row[0]) for row in written.select(column).distinct().collect()}
    empty = {str(value) for value in touched} - full
    for folder in listed(spark, table_path(root, name)) if empty else []:
        if folder.startswith(f"{column}=") and unquote(folder.removeprefix(f"{column}=")) in empty:
            remove(spark, f"{table_path(root, name)}/{folder}")


def _replace(spark: SparkSession, root: str, name: str, touched: list, rows: DataFrame) -> int:
    """Rewrite the touched partitions of a layer with these rows; returns their number."""
    place = scratch_folder(spark)
    stored = durable(rows, place)
    write_layer(stored, root, name, only_touched=True)
    _drop_emptied(spark, root, name, touched, stored)
    count = stored.count()
    discard(spark, place)
    return count


def _add_rejected(spark: SparkSession, root: str, candidates: dict[str, DataFrame]) -> int:
    """Append rejected records; those that a broken-off increment has added are not added again."""
    place = ["topic", "partition", "offset"]
    known = read_layer(spark, root, "silver_quarantine").select(*place)
    rejected = durable(typed.quarantined(candidates).join(known, place, "left_anti"))
    layer = LAYERS["silver_quarantine"]
    rejected.write.mode("append").partitionBy(*layer.partitions).parquet(table_path(root, layer.name))
    return rejected.count()


def increment(spark: SparkSession, root: str) -> dict[str, dict]:
    """Take the Bronze batches that are new into Silver and Gold.

    Returns rows and partitions written for each layer; nothing for no new batch. The
    batches are noted after the last write: an increment that broke off is repeated and
    writes the same rows. Without a first build the whole of Bronze is built.
    """
    table = applied_batches(spark, root)
    version, applied = table.read()
    if not version:
        return {name: {"rows": rows} for name, rows in rebuild(spark, root).items()}
    pending = [row[0] for row in _all_batches(spark, root).join(applied, "batch_id", "left_anti").collect()]
    if not pending:
        return {}
    # literal batch names prune the Bronze folders before a file is opened
    bronze = read_layer(spark, root, "bronze_events").where(F.col("batch_id").isin(*pending))
    report: dict[str, dict] = {}
    candidates = {
        spec.source: durable(typed.typed_candidates(bronze, spec)) for spec in SILVER_TABLES.values()
    }
    for name, spec in SILVER_TABLES.items():
        new = candidates[spec.source].where("is_valid")
        silver, column = read_layer(spark, root, name), LAYERS[name].partitions[0]
        touched = _touched(new, silver, spec, column)
        if not touched:
            continue
        here = silver.where(F.col(column).isin(*touched))
        merged = typed.latest_valid(here.unionByName(new.select(*silver.columns)), spec)
        report[name] = {"rows": _replace(spark, root, name, touched, merged), "partitions": touched}
    report["silver_quarantine"] = {"rows": _add_rejected(spark, root, candidates)}
    for name, (source, build) in GOLD_TABLES.items():
        if source in report:
            touched, column = report[source]["partitions"], LAYERS[source].partitions[0]
            silver = read_layer(spark, root, source).where(F.col(column).isin(*touched))
            report[name] = {
                "rows": _replace(spark, root, name, touched, build(silver)),
                "partitions": touched,
            }
    names = spark.createDataFrame([(batch,) for batch in pending], "batch_id STRING")
    table.commit(applied.unionByName(names), version)
    return report
