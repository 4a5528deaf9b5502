"""Exact median and MAD baselines of the newest points of many series.

Every scored point is compared with all *earlier* points of its series. Only
the newest ``points`` rows of a series are scored, so their histories differ by
at most ``points`` rows and all their order statistics lie close together. The
history therefore is never sorted, collected or windowed as a whole:

1. values are counted in narrow magnitude bins (map-side combined);
2. cumulated bin counts tell which few bins can hold a median or a MAD of any
   scored point; all other bins matter only through their counts;
3. only the values of those bins, collapsed to (value, count), are gathered per
   series and combined with the scored rows into the exact results.

If the bins of step 2 still hold too many different values they are split and
counted again until they do not.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amperline.session import durable

# Executors receive the per-series functions themselves, so a job also runs
# where the package is installed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SERIES = ["series", "component"]
BINS_PER_LOG_UNIT = 1024
SPLITS = 1024
# Values a series may gather besides a fixed multiple of the scored points, which can
# move every order statistic by as many places. Bins are 2**-10 wide relative to their
# values and a split makes them 2**10 times narrower, so after MAX_PASSES even doubles
# next to each other are in bins of their own and a further split changes nothing.
MAX_GATHERED_VALUES = 20_000
GATHERED_PER_POINT = 16
MAX_PASSES = 6
MARGIN = 1e-9

_RESULT = (
    "series STRING, component STRING, recency INT, points BIGINT, median DOUBLE, mad DOUBLE, "
    "mean DOUBLE, stddev DOUBLE"
)


def magnitude_bin(value: Column) -> Column:
    """Bin number that never decreases with the value."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * F.lit(BINS_PER_LOG_UNIT))


def count_bins(pool: DataFrame) -> DataFrame:
    """Count, range and moments of every bin."""
    return pool.groupBy(*SERIES, "bin").agg(
        F.count("*").alias("cnt"),
        F.min("value").alias("vmin"),
        F.max("value").alias("vmax"),
        F.avg("value").alias("avg"),
        (F.var_pop("value") * F.count("*")).alias("m2"),
    )


def bracket_bins(bins: DataFrame, points: int) -> DataFrame:
    """Flag the bins that can hold a median (central) or a MAD (edge).

    ``low`` and ``high`` enclose the history ranks any scored point can ask for.
    With at most ``points`` scored rows the ranks move by no more than that.
    """
    whole = Window.partitionBy(*SERIES)
    before = (Window.unboundedPreceding, -1)
    upto = (Window.unboundedPreceding, Window.currentRow)
    ranked = bins.select(
        "*",
        F.sum("cnt").over(whole).alias("n"),
        F.coalesce(F.sum("cnt").over(whole.orderBy("vmin").rowsBetween(*before)), F.lit(0)).alias(
            "below"
        ),
    ).withColumns(
        {
            "low": F.floor((F.col("n") + 1) / 2) - F.lit(points),
            "high": F.floor(F.col("n") / 2) + 1 + F.lit(points),
        }
    )
    central = (F.col("below") < F.col("high")) & (F.col("below") + F.col("cnt") >= F.col("low"))
    short = (F.col("low") < 1) | (F.col("high") > F.col("n"))
    spans = ranked.withColumns({"central": central, "short": short}).select(
        "*",
        F.min(F.when(F.col("central"), F.col("vmin"))).over(whole).alias("mlo"),
        F.max(F.when(F.col("central"), F.col("vmax"))).over(whole).alias("mhi"),
    )
    distances = spans.withColumns(
        {
            "dmin": F.greatest(
                F.lit(0.0), F.col("vmin") - F.col("mhi"), F.col("mlo") - F.col("vmax")
            ),
            "dmax": F.greatest(F.col("vmax") - F.col("mlo"), F.col("mhi") - F.col("vmin")),
        }
    ).select(
        "*",
        F.sum("cnt").over(whole.orderBy("dmax").rowsBetween(*upto)).alias("within"),
        F.coalesce(F.sum("cnt").over(whole.orderBy("dmin").rowsBetween(*before)), F.lit(0)).alias(
            "closer"
        ),
    )
    radii = distances.select(
        "*",
        F.max(F.when(F.col("closer") < F.col("low"), F.col("dmin"))).over(whole).alias("rlo"),
        F.min(F.when(F.col("within") >= F.col("high"), F.col("dmax"))).over(whole).alias("rhi"),
    )
    beyond_inner = F.col("dmax") >= F.col("rlo") * F.lit(1 - MARGIN)
    within_outer = F.col("dmin") <= F.col("rhi") * F.lit(1 + MARGIN)
    return radii.select(
        *SERIES,
        "bin",
        "cnt",
        "vmin",
        "vmax",
        "avg",
        "m2",
        "n",
        "below",
        (F.col("central") | F.col("short")).alias("central"),
        ((beyond_inner & within_outer) | F.col("short")).alias("edge"),
        (~beyond_inner & ~F.col("short")).alias("near"),
    )


def _split(pool: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the wanted bins, renumbered into finer bins."""
    order = Window.partitionBy(*SERIES).orderBy("vmin")
    numbered = wanted.select(
        *SERIES, "bin", "vmin", "vmax", F.row_number().over(order).cast("long").alias("_no")
    )
    share = F.coalesce(
        F.try_divide(F.col("value") - F.col("vmin"), F.col("vmax") - F.col("vmin")), F.lit(0.0)
    )
    inner = F.least(F.floor(share * F.lit(SPLITS)), F.lit(SPLITS - 1))
    finer = pool.join(durable(numbered), [*SERIES, "bin"])
    return finer.select(*SERIES, "value", (F.col("_no") * F.lit(SPLITS) + inner).alias("bin"))


def summarise_history(history: DataFrame, points: int) -> DataFrame:
    """One row per series and component that decides all order statistics.

    ``history`` has the columns ``series``, ``component`` and ``value``.
    """
    pool = history.withColumn("bin", magnitude_bin(F.col("value")))
    bins = count_bins(pool)
    most = MAX_GATHERED_VALUES + GATHERED_PER_POINT * points
    for passes_left in reversed(range(MAX_PASSES)):
        marked = durable(bracket_bins(bins, points))
        wanted = marked.where((F.col("central") | F.col("edge")) & F.col("bin").isNotNull())
        different = F.sum(F.when(F.col("vmin") < F.col("vmax"), F.col("cnt")).otherwise(1))
        largest = wanted.groupBy(*SERIES).agg(different.alias("k")).agg(F.max("k")).first()[0]
        if (largest or 0) <= most or not passes_left:
            break
        pool = _split(pool, wanted)
        settled = marked.where(~(F.col("central") | F.col("edge"))).withColumn(
            "bin", F.lit(None).cast("long")
        )
        bins = settled.select(*bins.columns).unionByName(count_bins(pool).select(*bins.columns))

    whole = Window.partitionBy(*SERIES)
    uniform = F.min("vmin").over(whole) == F.max("vmax").over(whole)
    mean = F.when(uniform, F.col("vmin")).otherwise(
        F.sum(F.col("avg") * F.col("cnt")).over(whole) / F.col("n")
    )
    apart = F.col("avg") - F.col("mean")
    summary = (
        marked.withColumns({"mean": mean, "uniform": uniform})
        .groupBy(*SERIES)
        .agg(
            F.first("n").alias("n"),
            F.first("mean").alias("mean"),
            F.sum(
                F.when(F.col("uniform"), F.lit(0.0)).otherwise(
                    F.col("m2") + F.col("cnt") * apart * apart
                )
            ).alias("m2"),
            F.min(F.when(F.col("central"), F.col("below"))).alias("below"),
            F.coalesce(F.sum(F.when(F.col("near"), F.col("cnt"))), F.lit(0)).alias("near"),
        )
    )
    gathered = (
        pool.join(wanted.select(*SERIES, "bin", "central", "edge"), [*SERIES, "bin"])
        .groupBy(*SERIES, "value", "central", "edge")
        .agg(F.count("*").alias("cnt"))
        .groupBy(*SERIES)
        .agg(
            F.array_sort(F.collect_list(F.struct("value", "cnt", "central", "edge"))).alias("kept")
        )
        .select(
            *SERIES,
            F.col("kept.value").alias("values"),
            F.col("kept.cnt").alias("counts"),
            F.col("kept.central").alias("central"),
            F.col("kept.edge").alias("edge"),
        )
    )
    return summary.join(gathered, SERIES)


def _kth(k: int, offset: int, values: np.ndarray, upto: np.ndarray, extra: np.ndarray) -> float:
    """k-th smallest of counted values (after ``offset`` smaller ones) and extras."""
    merged = np.sort(np.concatenate((values, extra)))
    counted = upto[np.searchsorted(values, merged, side="right")]
    ranks = offset + counted + np.searchsorted(extra, merged, side="right")
    return float(merged[np.searchsorted(ranks, k)])


def _middle(total: int, offset: int, values: np.ndarray, counts: np.ndarray, extra) -> float:
    upto = np.concatenate(([0], np.cumsum(counts)))
    low = _kth((total + 1) // 2, offset, values, upto, extra)
    high = _kth((total + 2) // 2, offset, values, upto, extra)
    return (low + high) / 2


def _score_series(row) -> Iterator[tuple]:
    """Baselines of the scored rows of one series, oldest first."""
    known = row.n == row.n and row.n is not None
    n, mean, m2 = (int(row.n), float(row.mean), float(row.m2)) if known else (0, 0.0, 0.0)
    below, near = (int(row.below), int(row.near)) if known else (0, 0)
    empty = np.empty(0)
    values = np.asarray(row.values, dtype=float) if known else empty
    counts = np.asarray(row.counts, dtype=np.int64) if known else empty.astype(np.int64)
    central = np.asarray(row.central, dtype=bool) if known else empty.astype(bool)
    edge = np.asarray(row.edge, dtype=bool) if known else empty.astype(bool)
    seen: list[float] = []
    for recency, value in zip(row.recencies, row.scored, strict=True):
        total = n + len(seen)
        median = mad = average = stddev = None
        if total:
            extra = np.sort(np.asarray(seen, dtype=float))
            median = _middle(total, below, values[central], counts[central], extra)
            apart = np.abs(values[edge] - median)
            order = np.argsort(apart, kind="stable")
            mad = _middle(
                total, near, apart[order], counts[edge][order], np.sort(np.abs(extra - median))
            )
            average = mean
            stddev = float(np.sqrt(m2 / (total - 1))) if total > 1 else None
        yield (row.series, row.component, int(recency), total, median, mad, average, stddev)
        if value is not None and value == value:
            seen.append(float(value))
            step = float(value) - mean
            mean += step / (total + 1)
            m2 += step * (float(value) - mean)


def _score_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [
        "series", "component", "recency", "points", "median", "mad", "mean", "stddev",
    ]
    for batch in batches:
        series = batch.itertuples(index=False, name="SeriesRow")
        rows = [result for row in series for result in _score_series(row)]
        frame = pd.DataFrame(rows, columns=names)
        yield frame.astype({"recency": "int32", "points": "int64"})


def baselines(scored: DataFrame, history: DataFrame, points: int) -> DataFrame:
    """Baseline of every scored row from strictly earlier values.

    ``scored`` has ``series``, ``component``, ``recency`` (1 is newest) and
    ``value``; ``history`` holds everything older than the oldest scored row.
    """
    tails = scored.groupBy(*SERIES).agg(
        F.sort_array(F.collect_list(F.struct("recency", "value")), asc=False).alias("tail")
    )
    return (
        tails.select(
            *SERIES,
            F.col("tail.recency").alias("recencies"),
            F.col("tail.value").alias("scored"),
        )
        .join(summarise_history(history, points), SERIES, "left")
        .mapInPandas(_score_batches, _RESULT)
    )


def exact_median(frame: DataFrame, key: str, value: str) -> DataFrame:
    """Exact interpolated median and count of a column per text key."""
    history = frame.where(F.col(value).isNotNull()).select(
        F.col(key).alias("series"), F.lit(value).alias("component"), F.col(value).alias("value")
    )
    asked = history.select(*SERIES).distinct().select(
        *SERIES, F.lit(1).alias("recency"), F.lit(None).cast("double").alias("value")
    )
    return baselines(asked, history, 1).select(
        F.col("series").alias(key), F.col("points").alias("n"), "median"
    )
