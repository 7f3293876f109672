"""Registered queries over the test tables, with an equivalent SQL for each."""

from workload import catalog, correlation, flows, rewrites, scalars, series, spans, streams  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
