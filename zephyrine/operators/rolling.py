"""Window computations.

Row-framed windows per sensor are the one place where a hot sensor could end in one task:
``Window.partitionBy(sensor)`` sorts the whole history of a sensor together.  ``over_slices``
gives the same result, but cuts every series into time slices, computes inside the slices, and
redoes only the rows near a cut on the thin set of rows near cuts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from zephyrine.functions import moments
from zephyrine.functions.rules import level, status
from zephyrine.functions.stats import guarded_std, rounded
from zephyrine.schemas import POLLUTANTS, ROLLING_WIDTHS, WINDOW_TYPES

_UNIT_MICROS = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros(width: str) -> int:
    count, unit = width.split()
    return int(count) * _UNIT_MICROS[unit.rstrip("s")]


Made = dict[str, Callable[[WindowSpec], Column]]


def over_slices(
    df: DataFrame,
    columns: Made | list[Made],
    *,
    before: int,
    after: int = 0,
    key: tuple[str, ...] = ("sensor_id",),
    time: str = "timestamp",
    tie_break: tuple[str, ...] = (),
    slice_width: str = "1 hour",
) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after`` rows ahead.

    ``columns`` maps a name to a function from an ordered window to a column.  A list of such
    maps is applied in turn, later ones may use earlier columns, and names that start with an
    underscore are dropped at the end.

    Rows are shuffled by (key, slice).  A row whose frame lies inside its slice is final there.
    The others lie within ``before``/``after`` rows of a cut; they are recomputed per key over
    the first and last ``before + after`` rows of every slice, which hold all rows their frames
    can touch.  That second set has at most ``2 * (before + after)`` rows per key and slice, so
    its size depends on the number of slices and not on the number of readings.  Series with
    few rows per slice take the second way only.
    """
    reach = before + after
    order = [F.col(time), *(F.col(c) for c in tie_break)]
    whole = Window.partitionBy(*key).orderBy(*order)
    local = Window.partitionBy(*key, "_slice").orderBy(*order)
    group = Window.partitionBy(*key, "_slice")

    slice_no = F.floor(F.unix_micros(F.col(time)) / F.lit(micros(slice_width)))
    ranked = (
        df.withColumn("_slice", slice_no)
        .withColumn("_rank", F.row_number().over(local))
        .withColumn("_size", F.count("*").over(group))
    )
    behind = F.col("_rank") - 1
    ahead = F.col("_size") - F.col("_rank")
    inner = (behind >= before) & (ahead >= after)
    near_cut = (behind < reach) | (ahead < reach)

    stages = columns if isinstance(columns, list) else [columns]
    helpers = [name for stage in stages for name in stage if name.startswith("_")]

    def compute(rows: DataFrame, window: WindowSpec) -> DataFrame:
        for stage in stages:
            rows = rows.withColumns({name: make(window) for name, make in stage.items()})
        return rows

    body = compute(ranked.filter(F.col("_size") > reach), local).filter(inner)
    seams = compute(ranked.filter(near_cut), whole).filter(~inner)
    return body.unionByName(seams).drop("_slice", "_rank", "_size", *helpers)


# --- per-row features ----------------------------------------------------------------


def rolling_columns(pollutants=POLLUTANTS, widths=ROLLING_WIDTHS) -> list[Made]:
    """Trailing mean and sample deviation over the last n rows; deviation of one value is 0.

    Spark evaluates a sliding frame from scratch for every row, so a frame of 60 rows costs 60
    updates per aggregate.  When each width is a multiple of the one before, only the shortest
    frame is evaluated that way; a longer frame is put together from the shorter ones that end
    a multiple of that width earlier.  Moments are merged around the common mean (Chan et al.),
    which is as stable as a direct computation.
    """
    widths = sorted(widths)
    steps = list(zip(widths, widths[1:], strict=False))
    if any(wide % narrow for narrow, wide in steps):
        return [_direct_columns(pollutants, widths)]

    first = widths[0]
    start: Made = {}
    for p in pollutants:
        framed = _framed_moments(p, first)
        for m in "nsq":
            start[f"_{m}{first}_{p}"] = lambda w, framed=framed, m=m: framed[m](w)
    stages = [start]
    for narrow, wide in steps:
        stages += _widen(pollutants, narrow, wide)
    last: Made = {}
    for p in pollutants:
        for k in widths:
            n, s, q = (f"_{m}{k}_{p}" for m in "nsq")
            last[f"{p}_mean_{k}"] = _sql(f"{s} / nullif({n}, 0D)")
            last[f"{p}_std_{k}"] = _sql(f"if({n} > 1, sqrt({q} / ({n} - 1)), 0D)")
    return [*stages, last]


def _framed_moments(name: str, width: int) -> Made:
    """Count, sum and sum of squared deviations over a sliding frame, 0 where it is empty."""

    def frame(w: WindowSpec) -> WindowSpec:
        return w.rowsBetween(1 - width, 0)

    zero = 0.0
    return {
        "n": lambda w: F.count(name).over(frame(w)).cast("double"),
        "s": lambda w: F.coalesce(F.sum(name).over(frame(w)), F.lit(zero)),
        "q": lambda w: F.coalesce(
            F.var_pop(name).over(frame(w)) * F.count(name).over(frame(w)), F.lit(zero)
        ),
    }


def _widen(pollutants, narrow: int, wide: int) -> list[Made]:
    """Moments over ``wide`` rows from those over ``narrow`` rows.

    Frames before the start of the series count as empty, so no column is null.
    """
    backs = range(narrow, wide, narrow)
    lags: Made = {}
    totals: Made = {}
    squares: Made = {}
    for p in pollutants:
        for m in "nsq":
            for back in backs:
                lags[f"_{m}{narrow}_{p}_{back}"] = lambda w, m=m, p=p, back=back: F.lag(
                    f"_{m}{narrow}_{p}", back, 0.0
                ).over(w)
        n, s, q = (
            [f"_{m}{narrow}_{p}{x}" for x in ("", *(f"_{back}" for back in backs))] for m in "nsq"
        )
        mean = f"_m{wide}_{p}"
        deviations = " + ".join(
            f"{qi} + {ni} * power({si} / greatest({ni}, 1D) - {mean}, 2)"
            for ni, si, qi in zip(n, s, q, strict=True)
        )
        totals[f"_n{wide}_{p}"] = _sql(" + ".join(n))
        totals[f"_s{wide}_{p}"] = _sql(" + ".join(s))
        totals[mean] = _sql(f"({' + '.join(s)}) / greatest({' + '.join(n)}, 1D)")
        squares[f"_q{wide}_{p}"] = _sql(deviations)
    return [lags, totals, squares]


def _sql(text: str) -> Callable[[WindowSpec], Column]:
    return lambda w: F.expr(text)


def _direct_columns(pollutants, widths) -> Made:
    made: Made = {}
    for p in pollutants:
        for n in widths:
            made[f"{p}_mean_{n}"] = lambda w, p=p, n=n: F.avg(p).over(w.rowsBetween(1 - n, 0))
            made[f"{p}_std_{n}"] = lambda w, p=p, n=n: F.coalesce(
                F.stddev_samp(p).over(w.rowsBetween(1 - n, 0)), F.lit(0.0)
            )
    return made


def delta_columns(pollutants=POLLUTANTS) -> Made:
    """Difference to the row before; 0 when either side is missing."""
    return {
        f"{p}_delta": lambda w, p=p: F.coalesce(F.col(p) - F.lag(p).over(w), F.lit(0.0))
        for p in pollutants
    }


def rolling_features(
    df: DataFrame, pollutants=POLLUTANTS, widths=ROLLING_WIDTHS, **layout
) -> DataFrame:
    present = [p for p in pollutants if p in df.columns]
    made = rolling_columns(present, widths)
    return over_slices(df, made, before=max(widths) - 1, **layout)


def delta_features(df: DataFrame, pollutants=POLLUTANTS, **layout) -> DataFrame:
    present = [p for p in pollutants if p in df.columns]
    return over_slices(df, delta_columns(present), before=1, **layout)


def forecast_target(
    df: DataFrame, target: str = "pm2_5", horizon: int = 1, **layout
) -> DataFrame:
    """``target`` = the value ``horizon`` rows ahead; rows without one are dropped."""
    made = {"target": lambda w: F.lead(target, horizon).over(w)}
    return over_slices(df, made, before=0, after=horizon, **layout).na.drop(subset=["target"])


# --- time windows --------------------------------------------------------------------

_STATISTICS = {
    "pm2_5": ("mean", "std", "min", "max"),
    "pm10": ("mean", "std"),
    "no2": ("mean", "std"),
    "o3": ("mean",),
    "co": ("mean",),
    "so2": ("mean",),
}
_AGGREGATE = {"mean": F.avg, "std": guarded_std, "min": F.min, "max": F.max}


def rolling_stats(
    readings: DataFrame,
    window_type: str,
    duration: str | None = None,
    slide: str | None = None,
    digits: int | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Statistics per sensor and event-time window; tumbling unless ``slide`` is given.

    The same expression runs on a stream, there with ``watermark`` as the wait for late rows.
    Pre-aggregation on the map side keeps a hot sensor cheap: it sends one row per window and
    input partition.
    """
    duration = duration or WINDOW_TYPES[window_type]
    source = readings if watermark is None else readings.withWatermark("timestamp", watermark)
    frame = F.window("timestamp", duration, slide) if slide else F.window("timestamp", duration)
    wanted = [
        rounded(_AGGREGATE[s](p), digits).alias(f"{p}_{s}")
        for p, stats in _STATISTICS.items()
        for s in stats
    ]
    return (
        source.groupBy("sensor_id", frame.alias("_window"))
        .agg(*wanted, F.count("*").alias("record_count"))
        .select(
            "sensor_id",
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            F.lit(window_type).alias("window_type"),
            *(f"{p}_{s}" for p, stats in _STATISTICS.items() for s in stats),
            "record_count",
        )
    )


_MOMENTS_OF = {"mean": ("n", "sum"), "std": ("n", "sum", "m2", "nonzero"), "min": ("min",), "max": ("max",)}
#: (pollutant, moment) pairs that the statistics need, and their columns.
_NEEDED = [
    (p, m) for p, stats in _STATISTICS.items() for m in dict.fromkeys(m for s in stats for m in _MOMENTS_OF[s])
]
MOMENTS = tuple(f"{p}_{m}" for p, m in _NEEDED)


def partial_moments(readings: DataFrame, window_type: str, duration: str) -> DataFrame:
    """Mergeable moments per sensor and tumbling window, and the newest timestamp of each."""
    made = {
        "n": lambda c: F.count(c).cast("double"),
        "sum": F.sum,
        "m2": lambda c: F.var_pop(c) * F.count(c),
        "nonzero": lambda c: F.count_if(c != 0).cast("double"),
        "min": F.min,
        "max": F.max,
    }
    return (
        readings.groupBy("sensor_id", F.window("timestamp", duration).alias("_window"))
        .agg(
            F.count("*").alias("record_count"),
            F.max("timestamp").alias("newest"),
            *(made[m](F.col(p)).alias(f"{p}_{m}") for p, m in _NEEDED),
        )
        .withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")})
        .withColumn("window_type", F.lit(window_type))
        .drop("_window")
    )


def merge_moments(parts: DataFrame, digits: int | None = None) -> DataFrame:
    """The statistics of ``rolling_stats`` from any number of moments per sensor and window."""
    key = ["sensor_id", "window_start", "window_end", "window_type"]
    every = Window.partitionBy(*key)
    spread = [p for p, m in _NEEDED if m == "m2"]
    means = {f"_mean_{p}": F.sum(f"{p}_sum").over(every) / F.nullif(F.sum(f"{p}_n").over(every), F.lit(0.0)) for p in spread}
    own = {
        p: F.sum(
            F.col(f"{p}_m2")
            + F.col(f"{p}_n") * F.pow(F.col(f"{p}_sum") / F.nullif(F.col(f"{p}_n"), F.lit(0.0)) - F.col(f"_mean_{p}"), 2)
        )
        for p in spread
    }

    def statistic(p: str, s: str) -> Column:
        n = F.sum(f"{p}_n")
        if s == "mean":
            return F.sum(f"{p}_sum") / F.nullif(n, F.lit(0.0))
        if s == "std":
            return F.when(F.sum(f"{p}_nonzero") > 1, F.sqrt(own[p] / (n - 1))).otherwise(F.lit(0.0))
        return (F.min if s == "min" else F.max)(f"{p}_{s}")

    wanted = [(p, s) for p, stats in _STATISTICS.items() for s in stats]
    return parts.withColumns(means).groupBy(*key).agg(
        *(rounded(statistic(p, s), digits).alias(f"{p}_{s}") for p, s in wanted),
        F.sum("record_count").alias("record_count"),
    )


def all_rolling_stats(
    readings: DataFrame, windows: dict[str, str] = WINDOW_TYPES, **options
) -> DataFrame:
    parts = [rolling_stats(readings, name, width, **options) for name, width in windows.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def bucket_averages(
    df: DataFrame,
    columns: dict[str, str],
    width: str = "5 minutes",
    keys: tuple[str, ...] = (),
    count_as: str | None = None,
    time: str = "timestamp",
) -> DataFrame:
    """Averages per time bucket and optional keys; ``columns`` maps input to output name."""
    aggregates = [F.avg(c).alias(name) for c, name in columns.items()]
    if count_as:
        aggregates.append(F.count("*").alias(count_as))
    return df.groupBy(*keys, moments.bucket_start(time, width).alias("bucket")).agg(*aggregates)


# --- latest and previous -------------------------------------------------------------


def latest_per_key(
    df: DataFrame, key: tuple[str, ...] = ("sensor_id",), order: tuple[str, ...] = ("timestamp",)
) -> DataFrame:
    """Newest row per key; name enough ``order`` columns to decide ties.

    Spark keeps one row per key and input partition before the shuffle, so a key holding most
    rows costs no more than any other.
    """
    newest = Window.partitionBy(*key).orderBy(*(F.col(c).desc() for c in order))
    return (
        df.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_per_sensor(measurements: DataFrame, tie_break: tuple[str, ...] = ()) -> DataFrame:
    newest = latest_per_key(measurements, order=("timestamp", *tie_break))
    return newest.withColumns({"aqi_status": status(), "aqi_level": level()})


def quality_trend(metrics: DataFrame) -> DataFrame:
    """Row count of the day before and the change, per table.

    One row per table and day, so the window per table stays small.
    """
    days = Window.partitionBy("table_name").orderBy("pipeline_date")
    before = F.lag("row_count").over(days)
    return metrics.withColumns(
        {"prev_row_count": before, "row_count_delta": F.col("row_count") - before}
    )


def share_of_total(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Share of each row in the column total; for results already reduced to a few rows."""
    everything = Window.partitionBy()
    return df.withColumns(
        {
            name: F.col(c).cast("double") / F.nullif(F.sum(c).over(everything), F.lit(0))
            for c, name in columns.items()
        }
    )
