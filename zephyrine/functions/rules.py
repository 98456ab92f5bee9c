"""Threshold rules.

Three rules exist side by side and differ on purpose: events use ``>=``, training labels use
``>`` on the critical limit only, and the live status uses ``>`` on three pollutants.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from zephyrine.schemas import THRESHOLDS, ZONE_CODES

STATUS_POLLUTANTS = ("pm2_5", "pm10", "no2")

# fixed values: pm2_5 above the limit -> level
LEVEL_LIMITS = ((75.0, 5), (55.0, 4), (35.0, 3), (12.0, 2))


def event_severity(value: Column, warning: Column, critical: Column) -> Column:
    """critical / warning / null, limits included."""
    return F.when(value >= critical, "critical").when(value >= warning, "warning")


def any_above(limits: dict[str, float]) -> Column:
    """True when a named column exceeds its limit; a null never does."""
    return reduce(
        lambda a, b: a | b,
        (F.coalesce(F.col(c) > F.lit(v), F.lit(False)) for c, v in limits.items()),
    )


def critical_label(columns: list[str] | None = None, thresholds=THRESHOLDS) -> Column:
    """1 when any pollutant that is present lies above its critical limit, else 0."""
    limits = {p: t[1] for p, t in thresholds.items() if columns is None or p in columns}
    return any_above(limits).cast("int")


def status(thresholds=THRESHOLDS, pollutants=STATUS_POLLUTANTS) -> Column:
    return (
        F.when(any_above({p: thresholds[p][1] for p in pollutants}), "critical")
        .when(any_above({p: thresholds[p][0] for p in pollutants}), "warning")
        .otherwise("good")
    )


def level(column: str = "pm2_5", limits=LEVEL_LIMITS) -> Column:
    chain = None
    for limit, grade in limits:
        test = F.col(column) > F.lit(limit)
        chain = F.when(test, grade) if chain is None else chain.when(test, grade)
    return chain.otherwise(1)


def zone_code(column: str = "zone", codes=ZONE_CODES) -> Column:
    """Unknown zones and nulls count as 0."""
    chain = None
    for name, code in codes.items():
        test = F.col(column) == name
        chain = F.when(test, code) if chain is None else chain.when(test, code)
    return chain.otherwise(0)
