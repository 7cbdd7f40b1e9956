"""Registered queries over the given tables, each with equivalent SQL where SQL can say it."""

from hazlake.plans.checks import (  # noqa: F401  (importing registers the checks)
    find_checks,
    job_checks,
    lake_checks,
    media_checks,
    payload_checks,
    report_checks,
    sensor_checks,
    store_checks,
    stream_checks,
    text_checks,
)
from hazlake.plans.checks.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
