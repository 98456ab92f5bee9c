"""Scoring of a reading stream with rolling features in event-time order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from zephyrine.operators.features import calendar_features
from zephyrine.operators.isolation import IsolationForest
from zephyrine.operators.scoring import score_batch
from zephyrine.operators.summaries import with_zone_code
from zephyrine.schemas import MEASURED
from zephyrine.session import keep_state_in_rocksdb

_HISTORY = 14  # rows before the current one that a 15-row window needs
_TRACKED = ("pm2_5", "pm10", "no2")

_FEATURES = {
    "pm2_5_mean_5": ("pm2_5", 5, "mean"),
    "pm2_5_std_5": ("pm2_5", 5, "std"),
    "pm2_5_mean_15": ("pm2_5", 15, "mean"),
    "pm2_5_std_15": ("pm2_5", 15, "std"),
    "pm10_mean_5": ("pm10", 5, "mean"),
    "no2_mean_5": ("no2", 5, "mean"),
}

_ROW = T.StructType(
    [
        T.StructField("at", T.LongType()),
        *(T.StructField(c, T.DoubleType()) for c in MEASURED),
        T.StructField("zone", T.StringType()),
    ]
)
_OUTPUT = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        *_ROW.fields,
        *(T.StructField(c, T.DoubleType()) for c in _FEATURES),
        T.StructField("pm2_5_delta", T.DoubleType()),
    ]
)
#: Waiting rows by column: the texts, and the numbers as bytes.
_BUCKET = T.StructType(
    [
        T.StructField("sensor_id", T.ArrayType(T.StringType())),
        T.StructField("zone", T.ArrayType(T.StringType())),
        T.StructField("at", T.BinaryType()),
        T.StructField("measured", T.BinaryType()),
    ]
)
#: Sensors, and the bytes of their last rows: sensors x _HISTORY x _TRACKED.
_PAST = T.StructType(
    [T.StructField("sensor_id", T.ArrayType(T.StringType())), T.StructField("tracked", T.BinaryType())]
)
_NUMBER = T.StructType([T.StructField("bucket", T.LongType())])


def _frames(series: np.ndarray, width: int) -> np.ndarray:
    """Row i holds the last ``width`` values up to i; places before the start are NaN."""
    padded = np.concatenate([np.full(width - 1, np.nan), series])
    return np.lib.stride_tricks.sliding_window_view(padded, width)


def _statistic(frames: np.ndarray, how: str) -> np.ndarray:
    """Mean (NaN without values) or sample deviation (0 below two values) of every frame.

    A frame's figure follows from its own values alone, so it is the same however a stream was cut.
    """
    known = ~np.isnan(frames)
    n = known.sum(axis=1)
    mean = np.where(known, frames, 0.0).sum(axis=1) / np.maximum(n, 1)
    if how == "mean":
        return np.where(n > 0, mean, np.nan)
    squares = np.where(known, frames - mean[:, None], 0.0) ** 2
    return np.where(n > 1, np.sqrt(squares.sum(axis=1) / np.maximum(n - 1, 1)), 0.0)


def _add_features(rows: pd.DataFrame, sensor: np.ndarray, past: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
    """(rows with features, the last values of every sensor then).

    ``rows`` are in the order of ``sensor``, numbers from 0 without a gap, and time.  ``past`` holds the last
    ``_HISTORY`` values of every sensor before them, NaN where there were none.  Laid before the sensor's own rows,
    they keep its frames from reaching into another sensor.
    """
    made, n = rows.copy(), len(past)
    own = np.arange(len(rows)) + _HISTORY * (sensor + 1)
    first = np.searchsorted(sensor, np.arange(n)) + _HISTORY * np.arange(n)
    last = np.searchsorted(sensor, np.arange(n), side="right") + _HISTORY * np.arange(n)
    block = np.arange(_HISTORY)
    series, kept = {}, np.empty_like(past)
    for k, c in enumerate(_TRACKED):
        series[c] = np.empty(len(rows) + past.shape[0] * _HISTORY)
        series[c][first[:, None] + block] = past[:, :, k]
        series[c][own] = rows[c].to_numpy(float)
        kept[:, :, k] = series[c][last[:, None] + block]
    for name, (column, width, how) in _FEATURES.items():
        made[name] = _statistic(_frames(series[column], width)[own], how)
    step = series["pm2_5"][own] - series["pm2_5"][own - 1]
    made["pm2_5_delta"] = np.where(np.isnan(step), 0.0, step)
    return made, kept


def _texts(values) -> list[str | None]:
    return [None if pd.isna(v) else v for v in values]


class _InTimeOrder(StatefulProcessor):
    """Holds the rows of a shard's sensors back until the watermark has passed them.

    Rows wait in buckets of ``width_ms`` of event time.  A timer fires when the watermark reaches the end of the first
    of them, after which no row of it can arrive; all buckets that the watermark has passed leave then, and a timer is
    set for the first one left.  So a sensor's rows leave in time order; rows of equal time are ordered by their
    values.  The state holds the waiting buckets and the last rows that left.  The calls to the state depend on the
    number of shards, buckets and batches, not on the number of sensors or rows.
    """

    def __init__(self, width_ms: int):
        self.width_ms = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", _NUMBER, _BUCKET)
        self.past = handle.getValueState("past", _PAST)

    def _wake_at(self, bucket: int) -> None:
        self.handle.registerTimer((bucket + 1) * self.width_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        if frame.empty:
            return iter(())
        at = frame["at"].to_numpy(np.int64)
        bucket = at // (self.width_ms * 1000)
        order = np.argsort(bucket, kind="stable")
        sensor, zone = (frame[c].to_numpy(object)[order] for c in ("sensor_id", "zone"))
        measured = frame[list(MEASURED)].to_numpy(float)[order]
        at, (numbers, starts) = at[order], np.unique(bucket[order], return_index=True)
        for number, low, high in zip(numbers.tolist(), starts, [*starts[1:], len(at)], strict=True):
            part = slice(low, high)
            new = _texts(sensor[part]), _texts(zone[part]), at[part].tobytes(), measured[part].tobytes()
            held = self.waiting.getValue((number,))
            if held is not None:
                new = tuple((list(a) if isinstance(b, list) else bytes(a)) + b for a, b in zip(held, new, strict=True))
            self.waiting.updateValue((number,), new)
        timers = list(self.handle.listTimers())
        if not timers or (int(numbers[0]) + 1) * self.width_ms < min(timers):
            self._wake_at(int(numbers[0]))
        return iter(())

    def _take(self, numbers: list[int]) -> pd.DataFrame:
        """The rows of these buckets, which wait no longer."""
        parts = []
        for number in numbers:
            sensor, zone, at, measured = self.waiting.getValue((number,))
            parts.append((list(sensor), list(zone), np.frombuffer(at, np.int64), np.frombuffer(measured, float)))
            self.waiting.removeKey((number,))
        sensor, zone, at, measured = zip(*parts, strict=True)
        rows = pd.DataFrame(np.concatenate(measured).reshape(-1, len(MEASURED)), columns=list(MEASURED))
        rows.insert(0, "at", np.concatenate(at))
        return rows.assign(zone=sum(zone, []), sensor_id=sum(sensor, []))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        waiting = sorted(number for (number,) in self.waiting.keys())
        ended = [number for number in waiting if (number + 1) * self.width_ms <= passed]
        if len(ended) < len(waiting):
            self._wake_at(waiting[len(ended)])
        if not ended:
            return
        rows = self._take(ended)
        sensors, past = [], np.empty((0, _HISTORY, len(_TRACKED)))
        if self.past.exists():
            sensors, stored = self.past.get()
            past = np.frombuffer(stored, float).reshape(-1, _HISTORY, len(_TRACKED))
        everyone = np.array([*sensors, *rows["sensor_id"]], object)
        number, names = pd.factorize(everyone, use_na_sentinel=False)
        known = np.full((len(names), _HISTORY, len(_TRACKED)), np.nan)
        known[: len(past)] = past
        rows["number"] = number[len(past) :]
        rows = rows.sort_values(["number", "at", *MEASURED, "zone"], ignore_index=True)
        there, place = np.unique(rows["number"].to_numpy(), return_inverse=True)
        made, known[there] = _add_features(rows, place, known[there])
        self.past.update((_texts(names), known.tobytes()))
        yield made[_OUTPUT.names]

    def close(self) -> None:
        pass


def score_stream(
    readings: DataFrame,
    classifier: PipelineModel | IsolationForest | None = None,
    forecasters: dict[str, PipelineModel] | None = None,
    model_name: str = "none",
    model_version: str = "none",
    watermark: str | None = "10 minutes",
    bucket_seconds: int = 60,
    shards: int = 256,
) -> DataFrame:
    """Scores of a stream of flat readings with ``zone``, from real rolling features."""
    rows = stream_features(readings, watermark, bucket_seconds, shards)
    return score_batch(rows, classifier, forecasters, model_name, model_version)


def stream_features(
    readings: DataFrame, watermark: str | None = "10 minutes", bucket_seconds: int = 60, shards: int = 256
) -> DataFrame:
    """Rolling, delta, calendar and zone features of a stream of flat readings with ``zone``.

    A sensor's rows are taken in the order of their timestamps, whatever their order of arrival and the size of the
    batches.  A row is given out once the watermark passes the end of its bucket of ``bucket_seconds``, and rows behind
    the watermark are dropped (``numRowsDroppedByWatermark``).  With ``watermark=None`` the stream's own holds.  Rows
    without a timestamp have no place in the order and are left out.  Sensors are dealt into ``shards`` by a hash, and a
    shard's sensors are worked on together; the number of shards belongs to the checkpoint and cannot change later.
    """
    keep_state_in_rocksdb(readings.sparkSession)
    rows = readings if watermark is None else readings.withWatermark("timestamp", watermark)
    rows = rows.filter("timestamp is not null").select(
        "sensor_id", "timestamp", F.unix_micros("timestamp").alias("at"), *MEASURED, "zone"
    )
    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("sensor_id"), F.lit(shards)).cast("int"))
    made = sharded.groupBy("shard").transformWithStateInPandas(
        _InTimeOrder(bucket_seconds * 1000), _OUTPUT, "append", "eventTime"
    )
    timed = made.withColumn("timestamp", F.timestamp_micros("at"))
    return with_zone_code(calendar_features(timed.select("sensor_id", "timestamp", *_OUTPUT.names[2:])))
