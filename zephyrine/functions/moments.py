"""Time expressions.  ``as_of`` stands in for "now" everywhere."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Metadata key of a partition date: the timestamp column that it is the UTC day of.
DAY_OF = "day_of"

Moment = Column | str | dt.datetime | dt.date


def instant(value: Moment) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp")
    return F.lit(value if isinstance(value, str) else str(value)).cast("timestamp")


def day_of(value: Moment) -> Column:
    return F.to_date(instant(value))


def since(ts: str | Column, as_of: Moment, lookback: str) -> Column:
    """``ts >= as_of - lookback``; the bound folds to a literal and reaches the scan."""
    return _col(ts) >= instant(as_of) - F.expr(f"INTERVAL {lookback}")


def on_day(ts: str | Column, day: Moment) -> Column:
    """Rows of one UTC day as a half-open range, so that the filter can be pushed down."""
    start = day_of(day).cast("timestamp")
    return (_col(ts) >= start) & (_col(ts) < start + F.expr("INTERVAL 1 day"))


def _partition_dates(df: DataFrame, ts: str) -> list[Column]:
    return [F.col(f.name) for f in df.schema.fields if f.metadata.get(DAY_OF) == ts]


def recent(df: DataFrame, ts: str, as_of: Moment, lookback: str) -> DataFrame:
    """Rows since ``as_of - lookback``; of a stored table only the date partitions from there on."""
    kept = df.filter(since(ts, as_of, lookback))
    first = F.to_date(instant(as_of) - F.expr(f"INTERVAL {lookback}"))
    for date in _partition_dates(df, ts):
        kept = kept.filter(date >= first)
    return kept


def within_day(df: DataFrame, ts: str, day: Moment) -> DataFrame:
    """Rows of one UTC day; of a stored table only that day's partition."""
    kept = df.filter(on_day(ts, day))
    for date in _partition_dates(df, ts):
        kept = kept.filter(date == day_of(day))
    return kept


def minutes_between(later: Moment | Column, earlier: str | Column) -> Column:
    return (F.unix_micros(instant(later)) - F.unix_micros(_col(earlier))) / F.lit(60e6)


def seconds_between(later: Moment | Column, earlier: str | Column) -> Column:
    return (F.unix_micros(instant(later)) - F.unix_micros(_col(earlier))) / F.lit(1e6)


def bucket_start(ts: str | Column, width: str = "5 minutes") -> Column:
    return F.window(_col(ts), width)["start"]


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
