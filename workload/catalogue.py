"""All registered queries."""

from workload import (  # noqa: F401
    aggregates,
    catalog_tables,
    learning,
    sinks,
    streams,
    tables_and_filters,
    windows_and_models,
)
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
