"""Exact rankings whose windows never hold more than one slice of the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amperline.session import durable

_BEFORE = (Window.unboundedPreceding, -1)


def _null_safe_join(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Equi-join on columns that may be NULL, keeping the left names."""
    other = right.select(
        *[F.col(name).alias(f"{name}__r") for name in names],
        *[name for name in right.columns if name not in names],
    )
    match = reduce(
        lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"{name}__r")) for name in names]
    )
    return left.join(other, match, how).drop(*[f"{name}__r" for name in names])


def row_number_by_range(
    frame: DataFrame, name: str, order: list[Column], groups: tuple[str, ...] = ()
) -> DataFrame:
    """``row_number`` per group (or over everything) without one big window.

    Rows are range-partitioned by group and order, so a hot group spreads over
    many slices. A row's number is the count of its group in earlier slices plus
    its position inside its own slice. The slice id is stored before it is used
    twice, because a recomputed range partitioning may cut elsewhere.
    """
    slices = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group).asc_nulls_first() for group in groups]
    sliced = durable(
        frame.repartitionByRange(slices, *keys, *order).withColumn(
            "_slice", F.spark_partition_id()
        )
    )
    earlier = Window.partitionBy(*groups, *([] if groups else [F.lit(0)]))
    offsets = (
        sliced.groupBy(*groups, "_slice")
        .count()
        .withColumn("_offset", F.sum("count").over(earlier.orderBy("_slice").rowsBetween(*_BEFORE)))
        .drop("count")
    )
    inside = Window.partitionBy(*groups, "_slice").orderBy(*order)
    number = F.coalesce("_offset", F.lit(0)) + F.row_number().over(inside)
    return (
        _null_safe_join(sliced, offsets, [*groups, "_slice"], "inner")
        .withColumn(name, number.cast("long"))
        .drop("_slice", "_offset")
    )


def row_numbers_by_range(
    stored: DataFrame, identity: list[str], ranks: dict[str, list[Column]], order: list[str]
) -> DataFrame:
    """Several ``row_number`` columns from one range layout.

    Each rank lists its group and its sort columns; these have the same types in all
    ranks, and ``order`` gives their common directions. Every row is laid out once per
    rank, narrow, with the rank as the first group, so that one sort and one set of
    prefix counts serve all. ``identity`` names the columns that tell rows of the
    durable frame apart; they may be NULL.
    """
    keys = [f"_key{at}" for at in range(len(order))]
    laid = [
        F.struct(
            F.lit(name).alias("_rank"),
            group.alias("_group"),
            *[column.alias(key) for column, key in zip(columns, keys, strict=True)],
        )
        for name, (group, *columns) in ranks.items()
    ]
    stacked = stored.select(*identity, F.inline(F.array(*laid)))
    directions = [getattr(F.col(key), way)() for key, way in zip(keys, order, strict=True)]
    numbered = row_number_by_range(stacked, "_number", directions, groups=("_rank", "_group"))
    wide = numbered.groupBy(*identity).agg(
        *[F.max(F.when(F.col("_rank") == name, F.col("_number"))).alias(name) for name in ranks]
    )
    return _null_safe_join(stored, wide, identity, "inner")


def dense_ranks_by_range(stored: DataFrame, ranks: dict[str, tuple[str, Column]]) -> DataFrame:
    """Several global ``dense_rank`` columns from one range layout.

    Each rank names a column of the durable frame and a number made of it that grows
    with the rank; NULL comes last. The distinct values are laid out, numbered and
    joined back.
    """
    laid = F.array(
        *[
            F.struct(F.lit(name).alias("_rank"), F.col(value).alias("_value"), place.alias("_place"))
            for name, (value, place) in ranks.items()
        ]
    )
    values = stored.select(F.inline(laid)).distinct()
    numbered = durable(
        row_number_by_range(values, "_number", [F.col("_place").asc_nulls_last()], groups=("_rank",))
    )
    for name, (value, _) in ranks.items():
        own = numbered.where(F.col("_rank") == name).select(
            F.col("_value").alias(value), F.col("_number").alias(name)
        )
        stored = _null_safe_join(stored, own, [value], "inner")
    return stored


def dense_rank_by_range(stored: DataFrame, name: str, value: str, order: Column) -> DataFrame:
    """Global ``dense_rank`` of one column.

    The distinct values are numbered and joined back. ``stored`` must be a
    durable frame: the join compares its values with themselves.
    """
    numbered = row_number_by_range(stored.select(value).distinct(), name, [order])
    return _null_safe_join(stored, numbered, [value], "inner")


def row_number_by_bucket(
    frame: DataFrame, name: str, groups: list[str], bucket: str, order: list[Column]
) -> DataFrame:
    """``row_number`` per group where ``bucket`` never decreases along ``order``.

    Counts per (group, bucket) give the offsets, so the row window only ever
    covers one bucket of one group. The join and the window share a shuffle.
    NULL is a group, and a bucket before all others, of its own.
    """
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(*_BEFORE)
    offsets = (
        frame.groupBy(*groups, bucket)
        .count()
        .withColumn("_offset", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
        .drop("count")
    )
    inside = Window.partitionBy(*groups, bucket).orderBy(*order)
    return (
        _null_safe_join(frame, offsets, [*groups, bucket], "inner")
        .withColumn(name, F.col("_offset") + F.row_number().over(inside))
        .drop("_offset")
    )
