"""Ordered validation rules as one Catalyst expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def first_failure(rules: Iterable[Rule]) -> Column:
    """Code of the first rule whose predicate is true, NULL when none is."""
    return F.coalesce(*[F.when(broken, F.lit(code)) for code, broken in rules])


def blank(name: str) -> Column:
    """True for NULL and for text that is empty once trimmed."""
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""


def missing(name: str) -> Column:
    return F.col(name).isNull()


def not_exactly(name: str, *allowed: str) -> Column:
    """True for NULL and for anything outside the allowed values."""
    return ~F.coalesce(F.col(name).isin(*allowed), F.lit(False))


def outside(name: str, low: float, high: float) -> Column:
    """True only for a present value outside the closed range."""
    return ~F.coalesce(F.col(name).between(low, high), F.lit(True))


def missing_or_outside(name: str, low: float, high: float) -> Column:
    return ~F.coalesce(F.col(name).between(low, high), F.lit(False))


def with_quality(frame, rules: Iterable[Rule]):
    """Add ``quality_error``, ``is_valid`` and ``quality_status``."""
    error = first_failure(rules)
    return frame.withColumn("quality_error", error).withColumns(
        {
            "is_valid": F.col("quality_error").isNull(),
            "quality_status": F.when(F.col("quality_error").isNull(), "PASS").otherwise("FAIL"),
        }
    )
