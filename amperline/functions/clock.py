"""Time helpers that never depend on the wall clock."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(moment: datetime | str) -> Column:
    """A timestamp literal in UTC; naive values are taken as UTC."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    moment = moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)
    return F.lit(moment.isoformat()).cast("timestamp")


def aware(moment: datetime) -> datetime:
    """Reject a moment without a UTC offset."""
    if moment.tzinfo is None:
        raise ValueError("the evaluation time must carry a UTC offset")
    return moment.astimezone(UTC)


def seconds_between(start: Column, end: Column) -> Column:
    """Non-negative elapsed seconds with microsecond precision."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.greatest(micros / F.lit(1e6), F.lit(0.0))


def hours_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def parse_hour(text: Column) -> Column:
    """Hour text as ``2026-08-10T05`` or ``2026-08-10T05:00:00``; else NULL."""
    whole = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}$"), F.concat(text, F.lit(":00:00")))
    full = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"), text)
    return F.try_to_timestamp(F.coalesce(whole, full))
