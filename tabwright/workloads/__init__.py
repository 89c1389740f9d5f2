"""Registered queries: every operator on the driver's tables, with the SQL that
must give the same result."""

from tabwright.workloads import modeling, profiling, quality, training, wide  # noqa: F401
from tabwright.workloads.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
