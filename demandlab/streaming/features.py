"""Lag and rolling features over a demand stream, with the recent values of each zone as state."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from demandlab.schemas import DEMAND, LAGS, ROLLING_FEATURES, WINDOW, ZONE, lag_features
from demandlab.streaming.io import event_time

STATE = T.StructType([
    T.StructField("values", T.ArrayType(T.DoubleType())),
    T.StructField("newest", T.LongType()),
])


def trailing_frames(values: np.ndarray, rows: int) -> np.ndarray:
    """Row i holds values[i-rows+1 .. i], padded with NaN before the start."""
    padded = np.concatenate([np.full(rows - 1, np.nan), values])
    return np.lib.stride_tricks.sliding_window_view(padded, rows)


def lagged(values: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([np.full(min(n, len(values)), np.nan), values[: max(len(values) - n, 0)]])


def history_features(values: np.ndarray, lags: Sequence[int]) -> dict[str, np.ndarray]:
    four, day_part = trailing_frames(values, 4), trailing_frames(values, 24)
    columns = {f"lag_{n}": lagged(values, n) for n in lags}
    columns["rolling_mean_4"] = four.mean(axis=1)
    columns["rolling_std_4"] = four.std(axis=1, ddof=1)
    columns["rolling_max_24"] = day_part.max(axis=1)
    columns["rolling_min_24"] = day_part.min(axis=1)
    return columns


def recent_mean(values: np.ndarray, rows: int = 5) -> dict[str, np.ndarray]:
    return {"moving_average": np.nanmean(trailing_frames(values, rows), axis=1)}


def with_series_state(stream: DataFrame, value: str, names: Sequence[str], keep: int,
                      compute: Callable[[np.ndarray], dict[str, np.ndarray]], ts: str = WINDOW,
                      zone: str = ZONE, lifetime: timedelta | None = None, delay: str = "0 seconds") -> DataFrame:
    """Adds series columns computed from each zone's last ``keep`` values and the new ones.

    A row not newer than the zone's newest row came too late for its place in
    the series: it is passed on with ``late = true`` and without features.

    With a ``lifetime`` a zone that had no row for longer starts a new series: its state goes when the
    watermark passes the newest row by ``lifetime``, and a row that comes after such a gap finds no
    history whether or not that has happened yet, so results do not depend on how rows are cut into
    batches. Rows behind the watermark (``delay``) are then dropped by Spark. Without one, state is kept for good.
    """
    flat = stream.select(
        zone, F.col(ts).cast("timestamp").alias(ts), F.col(value).cast("double").alias(value))
    if lifetime is not None:
        flat = event_time(flat, ts, delay)
    alive = None if lifetime is None else int(lifetime.total_seconds() * 1_000_000)
    output = T.StructType([
        T.StructField(zone, stream.schema[zone].dataType), T.StructField(ts, T.TimestampType()),
        T.StructField(value, T.DoubleType()), *[T.StructField(n, T.DoubleType()) for n in names],
        T.StructField("late", T.BooleanType()),
    ])

    def series_columns(history: list[float], rows: pd.DataFrame) -> tuple[pd.DataFrame, list[float]]:
        series = np.concatenate([np.asarray(history, dtype=float), rows[value].to_numpy(dtype=float)])
        new = {n: column[len(history):] for n, column in compute(series).items()}
        return rows.assign(late=False, **new), series[-keep:].tolist()

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(chunks), ignore_index=True).sort_values(ts, kind="stable", ignore_index=True)
        history, newest = state.get if state.exists else ([], None)
        stamps = rows[ts].astype("datetime64[us]").astype("int64")
        fresh = stamps > newest if newest is not None else pd.Series(True, index=rows.index)
        parts = [rows[~fresh].assign(late=True)]
        rows, stamps = rows[fresh].reset_index(drop=True), stamps[fresh].to_numpy()
        if len(rows):
            before = np.concatenate([[stamps[0] if newest is None else newest], stamps[:-1]])
            breaks = np.flatnonzero(stamps - before > alive) if alive is not None else np.zeros(0, dtype=int)
            for low, high in itertools.pairwise([0, *breaks.tolist(), len(rows)]):
                history = [] if low in breaks else history
                if high > low:
                    made, history = series_columns(history, rows.iloc[low:high])
                    parts.insert(-1, made)
            newest = int(stamps.max())
            state.update((history, newest))
        if alive is not None:
            state.setTimeoutTimestamp(max((newest + alive) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        made = [part.reindex(columns=output.fieldNames()) for part in parts if len(part)]
        yield pd.concat(made) if len(made) > 1 else made[0]

    timeout = GroupStateTimeout.NoTimeout if alive is None else GroupStateTimeout.EventTimeTimeout
    built = flat.groupBy(zone).applyInPandasWithState(step, output, STATE, "append", timeout)
    cleaned = {n: F.when(~F.isnan(n), F.col(n)) for n in names}
    return built.withColumns({ts: F.col(ts).cast("timestamp_ntz"), **cleaned})


def feature_stream(demand: DataFrame, lags: Sequence[int] = LAGS, lifetime: timedelta | None = None,
                   delay: str = "0 seconds") -> DataFrame:
    """Online twin of ``features.with_history``'s windowed columns; ``lifetime`` as for ``with_series_state``."""
    names = [*lag_features(lags), *ROLLING_FEATURES]
    keep = max([*lags, 23])
    return with_series_state(demand, DEMAND, names, keep, lambda v: history_features(v, lags),
                             lifetime=lifetime, delay=delay)


def moving_average_stream(rows: DataFrame, value: str, window: int = 5, ts: str = WINDOW,
                          zone: str = ZONE, lifetime: timedelta | None = None, delay: str = "0 seconds") -> DataFrame:
    """Mean of the last ``window`` values of the zone, fewer at the start; ``lifetime`` as for ``with_series_state``."""
    return with_series_state(rows, value, ["moving_average"], max(window - 1, 1),
                             lambda v: recent_mean(v, window), ts, zone, lifetime, delay)
