"""Time filters, written so that the bounds fold to literals and reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.functions import moments
from zephyrine.functions.moments import Moment


def filter_since(df: DataFrame, as_of: Moment, lookback: str, time: str = "timestamp") -> DataFrame:
    return moments.recent(df, time, as_of, lookback)


def filter_between(
    df: DataFrame, start: Moment, end: Moment, time: str = "timestamp"
) -> DataFrame:
    """Both ends included."""
    return df.filter(F.col(time).between(moments.instant(start), moments.instant(end)))


def filter_on_date(df: DataFrame, day: Moment, time: str = "timestamp") -> DataFrame:
    return moments.within_day(df, time, day)
