"""Sliding-window features of one sensor: statistics, lags, z-score, peaks, flags.

All frames are row frames ending at the current row. Missing readings take a
place in the frame but are no samples.
"""

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from fumarole.functions import as_flag, utc_date, utc_hour, weekend
from fumarole.plans.blocks import over_series
from fumarole.settings import THRESHOLD, TIME, VALUE, WINDOW


def frame(w: WindowSpec, window: int = WINDOW) -> WindowSpec:
    return w.rowsBetween(1 - window, 0)


def rolling_columns(
    over: WindowSpec, value: str = VALUE, min_mean: int = 1, min_std: int = 2
) -> dict[str, Column]:
    """Mean, deviation, minimum and maximum, null under the least number of samples."""
    x = F.col(value).cast("double")
    n = F.count(value).over(over)

    def least(c, k, own):
        return c if k <= own else F.when(n >= k, c)

    return {
        "rolling_avg": least(F.avg(x).over(over), min_mean, 1),
        "moving_std": least(F.stddev_samp(x).over(over), min_std, 2),
        "rolling_min": F.min(x).over(over),
        "rolling_max": F.max(x).over(over),
    }


def z_of(value: str = VALUE) -> Column:
    """Distance from the rolling mean in deviations; null where there is none."""
    return (F.col(value).cast("double") - F.col("rolling_avg")) / F.nullif(F.col("moving_std"), F.lit(0.0))


def lag_columns(w: WindowSpec, value: str = VALUE, lags=(1, 5)) -> dict[str, Column]:
    x = F.col(value).cast("double")
    before = {k: F.lag(x, k).over(w) for k in lags}
    cols = {f"lag_{k}": c for k, c in before.items()}
    cols["rate_of_change"] = x - (before[1] if 1 in before else F.lag(x, 1).over(w))
    return cols


def above_band(value: str = VALUE) -> Column:
    """1 where a reading exceeds its rolling mean by more than its deviation.

    Without deviation nothing can exceed; rounding of the mean must not count.
    """
    sd = F.coalesce(F.col("moving_std"), F.lit(0.0))
    return ((F.col(value).cast("double") > F.col("rolling_avg") + sd) & (sd > 0)).cast("int")


def stability() -> Column:
    return 1 / (1 + F.abs(F.coalesce(F.col("moving_std"), F.lit(0.0))))


def rule_flag(z: str = "z_score", threshold: float = THRESHOLD) -> Column:
    return as_flag(F.abs(F.col(z)) > threshold)


def rolling_stats(
    df: DataFrame, window: int = WINDOW, min_mean: int = 1, min_std: int = 2,
    block_rows: int | None = None,
) -> DataFrame:
    def build(rows, w):
        return rows.withColumns(rolling_columns(frame(w, window), VALUE, min_mean, min_std))

    return over_series(df, build, before=window - 1, block_rows=block_rows)


def lags_roc(df: DataFrame, lags=(1, 5), block_rows: int | None = None) -> DataFrame:
    def build(rows, w):
        return rows.withColumns(lag_columns(w, lags=lags))

    return over_series(df, build, before=max(lags), block_rows=block_rows)


def z_score(df: DataFrame) -> DataFrame:
    """Needs ``rolling_avg`` and ``moving_std``; 0 where the score is undefined."""
    return df.withColumn("z_score", F.coalesce(z_of(), F.lit(0.0)))


def stability_score(df: DataFrame) -> DataFrame:
    return df.withColumn("stability_score", stability())


def flag_anomalies(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return df.withColumn("anomaly_flag", rule_flag(threshold=threshold))


def peak_frequency(df: DataFrame, window: int = WINDOW, block_rows: int | None = None) -> DataFrame:
    """Rows of the window that stood above their own band when they arrived.

    Two frames one behind the other: a row depends on ``2 * (window - 1)`` rows.
    """
    def build(rows, w):
        over = frame(w, window)
        stats = rolling_columns(over)
        rows = rows.withColumns({k: stats[k] for k in ("rolling_avg", "moving_std")})
        return _peaks(rows, over)

    return over_series(df, build, before=2 * (window - 1), block_rows=block_rows)


def _peaks(rows: DataFrame, over: WindowSpec) -> DataFrame:
    rows = rows.withColumn("_above", above_band())
    peaks = F.coalesce(F.sum("_above").over(over), F.lit(0)).cast("int")
    return rows.withColumn("peak_frequency", peaks).drop("_above")


def time_features(df: DataFrame) -> DataFrame:
    """Hour, weekend and date in UTC."""
    ts, dtype = F.col(TIME), df.schema[TIME].dataType
    return with_reading_date(df.withColumns({
        "hour_of_day": utc_hour(ts, dtype), "is_weekend": weekend(utc_date(ts, dtype)),
    }))


def with_reading_date(df: DataFrame) -> DataFrame:
    day = utc_date(F.col(TIME), df.schema[TIME].dataType)
    return df.withColumn("reading_date", F.date_format(day, "yyyy-MM-dd"))


def feature_columns(rows: DataFrame, w: WindowSpec, window: int = WINDOW) -> DataFrame:
    """Rolling statistics, lags and peaks; a row depends on ``2 * (window - 1)`` rows before it."""
    over = frame(w, window)
    return _peaks(rows.withColumns({**rolling_columns(over), **lag_columns(w)}), over)


def rule_columns(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score, stability and flag, which follow from the row alone."""
    return flag_anomalies(stability_score(z_score(rows)), threshold)


def window_features(
    df: DataFrame, window: int = WINDOW, threshold: float = THRESHOLD, block_rows: int | None = None
) -> DataFrame:
    """All per-sensor features of a cleaned table in one pass over each series."""
    def build(rows, w):
        return feature_columns(rows, w, window)

    rows = df.drop("rolling_avg", "moving_std")
    rows = over_series(rows, build, before=2 * (window - 1), block_rows=block_rows)
    return rule_columns(time_features(rows), threshold)


def sliding_window_aggregates(
    df: DataFrame, window: int = WINDOW, block_rows: int | None = None
) -> DataFrame:
    """Moving mean, deviation, maximum, minimum and change under their table names."""
    def build(rows, w):
        stats = rolling_columns(frame(w, window))
        return rows.withColumns({
            "spark_rolling_avg": stats["rolling_avg"],
            "spark_moving_std": stats["moving_std"],
            "spark_max": stats["rolling_max"],
            "spark_min": stats["rolling_min"],
            "spark_rate_of_change": lag_columns(w)["rate_of_change"],
        })

    return over_series(df, build, before=window - 1, block_rows=block_rows)
