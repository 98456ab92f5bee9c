"""Insert-ignore, replace and add, as set operations on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.operators.validate import first_writer_wins


def new_rows(
    incoming: DataFrame,
    existing: DataFrame,
    key: tuple[str, ...],
    arrival: tuple[str, ...] | None = None,
) -> DataFrame:
    """Incoming rows whose key is not there yet, one per key."""
    unique = first_writer_wins(incoming, key, arrival) if arrival else incoming.dropDuplicates(
        list(key)
    )
    return unique.join(existing.select(*key), list(key), "left_anti")


def insert_ignore(
    existing: DataFrame,
    incoming: DataFrame,
    key: tuple[str, ...],
    arrival: tuple[str, ...] | None = None,
) -> DataFrame:
    """The table after inserting ``incoming`` where existing keys win."""
    return existing.unionByName(new_rows(incoming, existing, key, arrival))


def upsert_replace(existing: DataFrame, incoming: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """The table after inserting ``incoming`` where incoming keys win.

    ``incoming`` has one row per key.  Keys it lacks stay as they are.
    """
    kept = existing.join(incoming.select(*key), list(key), "left_anti")
    return kept.unionByName(incoming)


def upsert_add(
    existing: DataFrame,
    deltas: DataFrame,
    key: tuple[str, ...],
    add: tuple[str, ...],
    newest: tuple[str, ...] = (),
) -> DataFrame:
    """Counters are summed and times advance to the newest; order of arrival is irrelevant."""
    columns = [*key, *add, *newest]
    both = existing.select(*columns).unionByName(deltas.select(*columns))
    return both.groupBy(*key).agg(
        *(F.sum(c).alias(c) for c in add), *(F.max(c).alias(c) for c in newest)
    )
