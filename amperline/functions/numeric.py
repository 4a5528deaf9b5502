"""Guarded arithmetic, robust scores and severity labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scoring model.
MIN_HISTORY_POINTS = 24
MAX_DEVIATION_SCORE = 4.0
MAD_FACTOR = 0.6745
RISK_WEIGHTS = {"forecast": 0.70, "generation": 0.30}
PRESSURE_WEIGHTS = {"demand": 0.50, "forecast": 0.30, "generation": 0.20}
SEVERITY_CUTS = (("CRITICAL", 90.0), ("HIGH", 75.0), ("ELEVATED", 55.0))


def shown(value: Column | str, digits: int) -> Column:
    """Round for display: scale, round ties to even, scale back.

    ``F.round`` works on the shortest decimal text instead and moves a stored
    number just below a tie upwards, as in 9260761.405 to 9260761.41.
    """
    scale = F.lit(10.0**digits)
    return F.rint((F.col(value) if isinstance(value, str) else value) * scale) / scale


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; NULL when the denominator is NULL or zero."""
    return F.try_divide(part, whole) * F.lit(100.0)


def change_pct(current: Column, base: Column) -> Column:
    """Relative change in percent against a positive base."""
    return F.when(base > 0, (current - base) * F.lit(100.0) / base)


def gap_pct(gap: Column, demand: Column) -> Column:
    """Absolute generation gap as a share of positive demand."""
    return F.when(demand > 0, F.abs(gap / demand) * F.lit(100.0))


def severity(score: Column) -> Column:
    """Label of a score that is first rounded to the displayed decimal."""
    displayed = shown(score, 1)
    label = F.lit("NORMAL")
    for name, cut in reversed(SEVERITY_CUTS):
        label = F.when(displayed >= cut, F.lit(name)).otherwise(label)
    return label


def robust_score(
    current: Column,
    points: Column,
    median: Column,
    mad: Column,
    mean: Column,
    stddev: Column,
    *,
    high_only: bool = False,
    clamp_low: bool = False,
) -> Column:
    """Capped deviation of a value from its own history.

    The median/MAD form is used while MAD is positive, then the mean/stddev
    form, then zero. ``high_only`` ignores values at or below the median and
    keeps the sign of the fallback unless ``clamp_low`` is set.
    """
    if high_only:
        from_median, from_mean = current - median, current - mean
    else:
        from_median, from_mean = F.abs(current - median), F.abs(current - mean)
    score = F.when(mad > 0, F.lit(MAD_FACTOR) * from_median / mad).when(
        stddev > 0, from_mean / stddev
    )
    usable = points >= MIN_HISTORY_POINTS
    if high_only:
        usable = usable & (current > median)
    # least() and greatest() skip NULL, so the missing case is settled first.
    settled = F.coalesce(F.when(usable, score), F.lit(0.0))
    capped = F.least(settled, F.lit(MAX_DEVIATION_SCORE))
    return F.greatest(capped, F.lit(0.0)) if clamp_low else capped


def weighted_score(weights: dict[str, float], scores: dict[str, Column]) -> Column:
    """Weighted 0-100 score from component scores on the 0-4 scale."""
    total = sum((F.lit(weight) * scores[name] for name, weight in weights.items()), F.lit(0.0))
    return F.least(F.lit(100.0), F.lit(25.0) * total)
