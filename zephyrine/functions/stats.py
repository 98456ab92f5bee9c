"""Aggregate expressions with the guards the monitoring tables expect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(column: Column, digits: int | None) -> Column:
    return column if digits is None else F.round(column, digits)


def guarded_std(name: str) -> Column:
    """Sample deviation, but 0 unless more than one non-zero value was seen."""
    value = F.col(name)
    return F.when(F.count_if(value != 0) > 1, F.stddev_samp(value)).otherwise(F.lit(0.0))


def null_rate(name: str) -> Column:
    """Share of nulls, 0 for an empty input."""
    total = F.count("*")
    return F.coalesce(F.count_if(F.col(name).isNull()) / F.nullif(total, F.lit(0)), F.lit(0.0))


def percent_of(value: Column, base: Column) -> Column:
    return value.cast("double") / F.nullif(base, F.lit(0)) * 100


def drift_term(recent_share: Column, base_share: Column) -> Column:
    """One bucket's contribution to the population stability index."""
    return (recent_share - base_share) * F.ln(recent_share / base_share)
