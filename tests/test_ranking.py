import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from amperline.operators.ranking import (
    dense_rank_by_range,
    dense_ranks_by_range,
    row_number_by_bucket,
    row_number_by_range,
    row_numbers_by_range,
)
from amperline.session import durable


def skewed(spark):
    """One group holds half of all rows and one value repeats a lot."""
    rng = random.Random(7)
    rows = [
        ("hot" if i % 2 else f"g{i % 9}", rng.choice([None, 1.0, 1.0, rng.random()]), i)
        for i in range(3000)
    ]
    rows.append((None, 5.0, 3001))
    return spark.createDataFrame(rows, "g string, v double, id int")


def test_row_numbers_match_one_big_window(spark):
    frame = durable(skewed(spark))
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    for groups in ((), ("g",)):
        ours = row_number_by_range(frame, "n", order, groups)
        window = Window.partitionBy(*groups, F.lit(1)).orderBy(*order)
        wanted = frame.withColumn("n", F.row_number().over(window).cast("long"))
        assert sorted(map(str, ours.collect())) == sorted(map(str, wanted.collect()))


def test_dense_ranks_match_one_big_window(spark):
    frame = durable(skewed(spark))
    for order in (F.col("v").asc_nulls_last(), F.col("v").desc_nulls_last()):
        ours = dense_rank_by_range(frame, "n", "v", order)
        wanted = frame.withColumn(
            "n", F.dense_rank().over(Window.partitionBy(F.lit(1)).orderBy(order)).cast("long")
        )
        assert sorted(map(str, ours.collect())) == sorted(map(str, wanted.collect()))


def test_several_ranks_from_one_layout(spark):
    frame = durable(skewed(spark).withColumn("w", F.col("id") % 13).union(spark.sql("SELECT 'x', NULL, NULL, 5L")))
    none = F.lit(None).cast("string")
    ours = row_numbers_by_range(
        frame,
        ["id"],
        {
            "in_group": [F.col("g"), F.col("w"), -F.col("id"), none],
            "overall": [none, F.col("w"), -F.col("id"), F.col("g")],
        },
        ["desc", "asc_nulls_last", "asc_nulls_last"],
    )
    order = [F.col("w").desc(), (-F.col("id")).asc_nulls_last()]
    wanted = frame.withColumns(
        {
            "in_group": F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("long"),
            "overall": F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order, F.col("g"))).cast("long"),
        }
    )
    assert sorted(map(str, ours.collect())) == sorted(map(str, wanted.collect()))


def test_several_dense_ranks_from_one_layout(spark):
    frame = durable(skewed(spark))
    ours = dense_ranks_by_range(frame, {"up": ("v", F.col("v")), "down": ("id", -F.col("id").cast("double"))})
    one = Window.partitionBy(F.lit(1))
    wanted = frame.withColumns(
        {
            "up": F.dense_rank().over(one.orderBy(F.col("v").asc_nulls_last())).cast("long"),
            "down": F.dense_rank().over(one.orderBy(F.col("id").desc())).cast("long"),
        }
    )
    assert sorted(map(str, ours.select(*wanted.columns).collect())) == sorted(map(str, wanted.collect()))


def test_bucket_numbers_keep_null_groups_and_buckets(spark):
    rows = [(None, 1, 1), (None, None, 2), ("a", None, 3), ("a", 2, 4), ("a", 2, 5)]
    frame = spark.createDataFrame(rows, "g string, b int, v int")
    found = row_number_by_bucket(frame, "n", ["g"], "b", [F.col("v")]).collect()
    assert sorted((r.v, r.n) for r in found) == [(1, 2), (2, 1), (3, 1), (4, 2), (5, 3)]
