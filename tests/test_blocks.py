"""Blocks with halo rows give what plain per-sensor windows give."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fumarole.operators import clean, windows
from fumarole.plans.blocks import cell_table

START = pd.Timestamp("2024-01-01")


def series(lengths, seed, gaps=0.2, burst=()):
    """Sensors of given lengths at irregular instants; ``burst`` ones crowd a third into a second."""
    rng = np.random.default_rng(seed)
    parts = []
    for k, n in enumerate(lengths):
        seconds = np.sort(rng.choice(n * 50, n, replace=False)).astype("float64")
        if k in burst:
            crowd = np.arange(n // 3) * 1e-3 + 20.0001
            seconds = np.unique(np.concatenate([seconds[: n - n // 3], crowd]))
        x = np.round(rng.normal(100, 5, len(seconds)), 3)
        x[rng.random(len(x)) < gaps] = np.nan
        run = rng.integers(0, max(1, len(x) - 40))
        x[run:run + 35] = np.nan
        parts.append(pd.DataFrame({
            "sensor_id": f"S{k + 1:02d}", "timestamp": START + pd.to_timedelta(seconds, unit="s"),
            "reading_value": x,
        }))
    return pd.concat(parts)


def frame(spark, pdf, kind="timestamp_ntz"):
    rows = spark.createDataFrame(pdf).withColumn("timestamp", F.col("timestamp").cast(kind))
    value = F.nanvl(F.col("reading_value"), F.lit(None).cast("double")).cast("float")
    return rows.withColumn("reading_value", value).repartition(5)


def rows_of(df):
    pdf = df.select(sorted(df.columns)).toPandas()
    return pdf.sort_values(["sensor_id", "timestamp"]).reset_index(drop=True)


OPERATORS = {
    "rolling": windows.rolling_stats,
    "lags": windows.lags_roc,
    "peaks": windows.peak_frequency,
    "features": windows.window_features,
    "sliding": windows.sliding_window_aggregates,
    "gaps": clean.gap_fill_short,
    "clean": clean.clean_windows,
    "runs": clean.missing_runs,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
@pytest.mark.parametrize("block_rows,kind", [(37, "timestamp_ntz"), (200, "timestamp")])
def test_blocks_equal_plain_windows(spark, name, block_rows, kind):
    df = frame(spark, series([900, 20, 1, 420], seed=block_rows, burst=(0,)), kind)
    plain = rows_of(OPERATORS[name](df))
    cut = rows_of(OPERATORS[name](df, block_rows=block_rows))
    pd.testing.assert_frame_equal(plain, cut, check_exact=True)


def test_only_long_series_are_cut(spark):
    df = frame(spark, series([500, 30], seed=1))
    assert cell_table(df, 29, 0, "sensor_id", "timestamp", 600) is None
    cells = cell_table(df, 29, 0, "sensor_id", "timestamp", 100)
    assert set(cells.cells["sensor_id"]) == {"S01"}


def test_a_burst_is_sliced_again(spark):
    df = frame(spark, series([3000], seed=2, burst=(0,)))
    cells = cell_table(df, 29, 3, "sensor_id", "timestamp", 100)
    assert len(cells.levels) > 1
    copies = cells.copies(df).where("_block = _own").groupBy("_block").count().toPandas()
    assert copies["count"].sum() == df.count()
    assert copies["count"].max() <= 300


def test_block_count_is_bounded(spark):
    df = frame(spark, series([2000], seed=3))
    cells = cell_table(df, 29, 0, "sensor_id", "timestamp", 10, max_blocks=8)
    assert cells.cells["_own"].max() < 9


def test_hot_sensor_spreads_over_tasks(spark):
    """A sensor with most rows ends in many window groups, none much above the block size."""
    df = frame(spark, series([4000, 100, 100], seed=4))
    cells = cell_table(df, 58, 0, "sensor_id", "timestamp", 250)
    groups = cells.copies(df).groupBy("sensor_id", "_block").count().toPandas()
    assert (groups["sensor_id"] == "S01").sum() >= 12
    assert groups["count"].max() <= 4 * 250


def test_missing_rows_everywhere(spark):
    pdf = series([300], seed=5)
    pdf["reading_value"] = np.nan
    df = frame(spark, pdf)
    plain, cut = (rows_of(clean.missing_runs(df, block_rows=b)) for b in (None, 40))
    pd.testing.assert_frame_equal(plain, cut)
    assert plain["gap_size"].unique().tolist() == [300]


def test_runs_without_a_sensor_are_kept_in_blocks(spark):
    rows = [("a", i, None if i % 5 == 0 else 1.0) for i in range(60)] + [(None, i, None) for i in range(3)]
    df = spark.createDataFrame(rows, "sensor_id string, m long, reading_value double")
    df = df.select("sensor_id", F.timestamp_seconds(F.col("m") * 60).alias("timestamp"), "reading_value")
    plain, cut = (clean.missing_runs(df, block_rows=b) for b in (None, 10))
    assert plain.count() == cut.count() == 63
    names = ["sensor_id", "timestamp", "is_missing", "run_id", "gap_size"]
    assert plain.select(names).exceptAll(cut.select(names)).isEmpty()
