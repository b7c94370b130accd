"""Features across sensors: per-instant correlation and mean, correlation matrix, pivot."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumarole.functions import co_correlation, guarded_corr
from fumarole.plans.sizing import lookup, salted_join, small_side, stored
from fumarole.settings import SENSOR, TIME, VALUE

NORMALIZED = "reading_normalized"
MOMENTS = ["n", "sx", "sy", "sxx", "syy", "sxy"]
#: Readings that a task holds as a dense matrix, about.
BLOCK_READINGS = 4_000_000


def cell_means(df: DataFrame, value: str) -> DataFrame:
    """One value per (instant, sensor): the mean of its rows, missing ones skipped."""
    return df.groupBy(TIME, SENSOR).agg(F.avg(F.col(value).cast("double")).alias(value))


def _instants(df: DataFrame, value: str, levels: DataFrame | None = None) -> tuple[DataFrame, bool]:
    """Per-instant features, and whether the sensors are few enough to bound an instant's rows."""
    x = F.col(value).cast("double")
    rows = df.select(TIME, SENSOR, x.alias("_x"))
    means = rows.groupBy(SENSOR).agg(F.avg("_x").alias("_mean")) if levels is None else levels
    side = small_side(means)
    joined = salted_join(rows, means, [SENSOR]) if side is None else rows.join(side, SENSOR, "left")
    out = joined.groupBy(TIME).agg(
        F.count("_x").alias("_n"),
        F.coalesce(guarded_corr(F.col("_x"), F.col("_mean")), F.lit(0.0)).alias("sensor_correlation"),
        (F.avg("_x") * 100).alias("gas_concentration_est"),
    )
    return out, side is not None


def sensor_correlation(df: DataFrame, value: str = NORMALIZED) -> DataFrame:
    """Per instant with any value: correlation of its sensors with their mean levels.

    0 with fewer than two values or without variation. Rows must be unique per
    sensor and instant, as ``dedup_keep_last`` leaves them; else use ``cell_means`` first.
    """
    out, _ = _instants(df, value)
    return out.where(F.col("_n") > 0).select(TIME, "sensor_correlation")


def gas_estimate(df: DataFrame, value: str = NORMALIZED) -> DataFrame:
    """Per instant: mean over its sensors times 100, null when all are missing."""
    mean = F.avg(F.col(value).cast("double")) * 100
    return df.groupBy(TIME).agg(mean.alias("gas_concentration_est"))


def cross_features(df: DataFrame, value: str = NORMALIZED, levels: DataFrame | None = None) -> DataFrame:
    """Both per-instant features on every row of the instant.

    ``levels`` may give the sensors' mean levels (_mean), as of a longer history.
    """
    instants, few = _instants(df, value, levels)
    instants = instants.drop("_n")
    # An instant has at most one row per sensor: with the sensors bounded, so is a join key.
    return df.join(instants, TIME, "left") if few else salted_join(df, instants, [TIME])


def pivot_mean(df: DataFrame, sensors: list[str], value: str = VALUE) -> DataFrame:
    """One row per instant, one column per sensor; instants without any value vanish."""
    wide = df.groupBy(TIME).pivot(SENSOR, list(sensors)).agg(F.avg(F.col(value).cast("double")))
    return wide.where(F.coalesce(*[F.col(f"`{s}`") for s in sensors]).isNotNull())


def correlation_matrix(df: DataFrame, value: str = VALUE, tile: int = 256, block_rows: int = BLOCK_READINGS) -> DataFrame:
    """Pairwise-complete Pearson correlation of every two sensors over the instants.

    Sensors are dealt into tiles of about ``tile`` and instants into blocks. A reading goes to every
    pair of tiles that its own belongs to, in one shuffle by (tile, tile, block); each such group is a
    dense matrix that is reduced to moments of its pairs, and these are summed. Nothing is emitted
    per pair and instant, there is no self join, and the names of sensors stay where they are.
    Several readings of a sensor and instant count as their mean.
    """
    x = F.col(value).cast("double")
    means = df.where(F.col(SENSOR).isNotNull()).groupBy(SENSOR).agg(F.avg(x).alias("_mean"), F.count(F.lit(1)).alias("_n"))
    means = stored(means, "sensor_means")
    size = means.agg(F.count(F.lit(1)).alias("sensors"), F.sum("_n").alias("rows")).first()
    tiles = max(1, math.ceil(size["sensors"] / tile))
    blocks = max(1, math.ceil(2 * (size["rows"] or 0) / tiles / block_rows))
    # Centring first keeps the sums of squares exact enough to subtract.
    own = F.pmod(F.xxhash64(SENSOR), F.lit(tiles)).cast("int")
    centred = lookup(df.where(F.col(SENSOR).isNotNull()).select(TIME, SENSOR, x.alias("_x")), means.select(SENSOR, "_mean"), [SENSOR]).select(
        F.col(TIME).alias("instant"), F.col(SENSOR).alias("sensor"), (F.col("_x") - F.col("_mean")).alias("x"), own.alias("own"),
        F.pmod(F.xxhash64(TIME), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("other"))
    dealt = centred.withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")})
    schema = "sensor_a string, sensor_b string, " + ", ".join(f"{c} double" for c in MOMENTS)
    sums = dealt.groupBy("p", "q", "block").applyInPandas(_moments, schema)
    pairs = sums.groupBy("sensor_a", "sensor_b").agg(*[F.sum(c).alias(c) for c in MOMENTS])
    pairs = pairs.withColumn("correlation", co_correlation(*[F.col(c) for c in MOMENTS]))
    a, b, r = F.col("sensor_a"), F.col("sensor_b"), F.col("correlation")
    both = F.array(F.struct(a, b, r), F.struct(b.alias("sensor_a"), a.alias("sensor_b"), r))
    one = F.array(F.struct(a, b, r))
    return pairs.select(F.inline(F.when(a == b, one).otherwise(both)))


def _moments(rows: pd.DataFrame) -> pd.DataFrame:
    """Moments of the pairs of sensors between two tiles, over the instants of a block."""
    at, _ = pd.factorize(rows["instant"], use_na_sentinel=False)
    column, names = pd.factorize(rows["sensor"], sort=True)
    x, shape = rows["x"].to_numpy("float64", na_value=np.nan), (at.max() + 1, len(names))
    held = ~np.isnan(x)
    count, total = np.zeros(shape), np.zeros(shape)
    np.add.at(count, (at[held], column[held]), 1.0)
    np.add.at(total, (at[held], column[held]), x[held])
    m = (count > 0).astype("float64")
    x = np.divide(total, count, out=np.zeros(shape), where=count > 0)
    n, s, ss, xy = m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x
    a, b = np.triu_indices(len(names))
    p, q = rows["p"].iloc[0], rows["q"].iloc[0]
    if p != q:  # pairs within a tile are taken where it meets itself
        tile = np.zeros(len(names), "int64")
        tile[column] = rows["own"].to_numpy()
        a, b = a[(across := tile[a] != tile[b])], b[across]
    names = np.array(names, dtype=object)
    return pd.DataFrame({
        "sensor_a": names[a], "sensor_b": names[b], "n": n[a, b], "sx": s[a, b], "sy": s[b, a],
        "sxx": ss[a, b], "syy": ss[b, a], "sxy": xy[a, b],
    })
