"""hazlake: hazard-signal lakehouse jobs written as plain PySpark DataFrames."""

from hazlake.plans.lake import Lake
from hazlake.session import build_session

__all__ = ["Lake", "build_session"]
