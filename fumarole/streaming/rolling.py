"""Row-window features on a stream, with keyed state.

Row windows depend on order, which a stream does not keep. Each sensor holds its
rows until the watermark has passed them, then emits them in time order with the
values of the batch operators. The state of a sensor is the rows still held and
the last ``2 * (window - 1)`` readings.
"""

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fumarole.settings import ALERT, MAX_GAP, SENSOR, THRESHOLD, TIME, VALUE, WINDOW

OUTPUT = (
    "sensor_id string, timestamp timestamp, reading_value double, is_imputed int, "
    "rolling_avg double, moving_std double, rolling_min double, rolling_max double, "
    "lag_1 double, lag_5 double, rate_of_change double, z_score double, "
    "peak_frequency int, stability_score double, anomaly_flag int"
)
STATE = "held_at array<long>, held array<double>, tail array<double>"


def window_values(x: np.ndarray, start: int, window: int, threshold: float) -> dict[str, np.ndarray]:
    """Features of ``x[start:]``; the values before ``start`` are its past."""
    pad = np.concatenate([np.full(window - 1, np.nan), x])
    frames = np.lib.stride_tricks.sliding_window_view(pad, window)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)
        mean, low, high = np.nanmean(frames, axis=1), np.nanmin(frames, axis=1), np.nanmax(frames, axis=1)
        std = np.nanstd(frames, axis=1, ddof=1)
    std[np.count_nonzero(~np.isnan(frames), axis=1) < 2] = np.nan
    band = np.nan_to_num(std)
    above = (x > mean + band) & (band > 0)
    peaks = np.convolve(above, np.ones(window))[: len(x)].round().astype("int32")
    lag = {k: np.concatenate([np.full(k, np.nan), x])[: len(x)] for k in (1, 5)}
    z = np.nan_to_num((x - mean) / np.where(band > 0, band, np.nan))
    out = {
        "rolling_avg": mean, "moving_std": std, "rolling_min": low, "rolling_max": high,
        "lag_1": lag[1], "lag_5": lag[5], "rate_of_change": x - lag[1], "z_score": z,
        "peak_frequency": peaks, "stability_score": 1 / (1 + band),
        "anomaly_flag": (np.abs(z) > threshold).astype("int32"),
    }
    return {k: v[start:] for k, v in out.items()}


def fill_settled(x: np.ndarray, tail: np.ndarray, max_gap: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(values, flags, settled count) of new readings behind ``tail``.

    A missing run at the end that may still turn out short is not settled yet.
    A tail that ends in a missing value belongs to a run already known as long.
    """
    values, flags = x.copy(), np.zeros(len(x), dtype="int32")
    i, long_run = 0, len(tail) > 0 and np.isnan(tail[-1])
    while i < len(x):
        if not np.isnan(x[i]):
            i, long_run = i + 1, False
            continue
        end = i
        while end < len(x) and np.isnan(x[end]):
            end += 1
        if not long_run and end - i <= max_gap:
            if end == len(x):
                return values[:i], flags[:i], i
            before = values[i - 1] if i else (tail[-1] if len(tail) else np.nan)
            values[i:end], flags[i:end] = before, 1
        long_run, i = True, end
    return values, flags, len(x)


def stream_rolling(
    readings: DataFrame, delay: str = "10 minutes", window: int = WINDOW, max_gap: int = MAX_GAP,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Gap fill and window features of a stream, one row per reading the watermark settled.

    Readings must be unique per sensor and instant. Rows behind the watermark are
    dropped; the query's progress counts them as ``numRowsDroppedByWatermark``.
    """
    past = 2 * (window - 1)

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, held, tail = state.get if state.exists else ([], [], [])
        at, held = [np.array(at, dtype="int64")], [np.array(held, dtype="float64")]
        tail = np.array(tail, dtype="float64")
        if not state.hasTimedOut:
            for chunk in chunks:
                at.append(chunk["_t"].to_numpy("int64"))
                held.append(chunk["_x"].to_numpy("float64"))
        t, x = np.concatenate(at), np.concatenate(held)
        order = np.argsort(t, kind="stable")
        t, x = t[order], x[order]
        mark = state.getCurrentWatermarkMs()
        ready = int(np.searchsorted(t, mark * 1000, side="right"))
        filled, flags, done = fill_settled(x[:ready], tail, max_gap)
        if done:
            values = np.concatenate([tail, filled])
            columns = window_values(values, len(tail), window, threshold)
            yield pd.DataFrame({
                SENSOR: key[0], TIME: pd.to_datetime(t[:done], unit="us"), VALUE: filled,
                "is_imputed": flags, **columns,
            })
            tail = values[-past:]
        state.update((t[done:].tolist(), _nullable(x[done:]), _nullable(tail)))
        if ready < len(t):
            state.setTimeoutTimestamp(max(int(t[ready] // 1000) + 1, mark + 1))

    rows = readings.withWatermark(TIME, delay).select(
        SENSOR, TIME, F.unix_micros(TIME).alias("_t"), F.col(VALUE).cast("double").alias("_x")
    )
    return rows.groupBy(SENSOR).applyInPandasWithState(
        step, OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def _nullable(x: np.ndarray) -> list:
    return [None if np.isnan(v) else float(v) for v in x]


def stream_alerts(features: DataFrame) -> DataFrame:
    """Flagged rows of a feature stream, as they are emitted."""
    return features.where(F.col("anomaly_flag") == 1).select(
        TIME, SENSOR, VALUE, "z_score", F.lit(ALERT).alias("alert")
    )
