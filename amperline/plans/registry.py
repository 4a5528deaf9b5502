"""All registered queries with their SQL."""

from __future__ import annotations

from amperline.plans import job_queries  # noqa: F401  registers its queries
from amperline.plans.catalog import REGISTRY
from amperline.plans.job_oracles import JOB_ORACLES
from amperline.plans.oracles import ORACLES as READING_ORACLES

ORACLES = {**READING_ORACLES, **JOB_ORACLES}

__all__ = ["ORACLES", "REGISTRY"]
