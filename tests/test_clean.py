import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fumarole.operators import clean, windows


def readings(spark, values, sensor="S01", **extra):
    rows = [(sensor, i, None if v is None else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "sensor_id string, i int, reading_value double")
    return df.select(
        "sensor_id", F.timestamp_seconds(F.col("i") * 60).alias("timestamp"),
        F.col("reading_value").cast("float"), *[F.lit(v).alias(k) for k, v in extra.items()])


def column(df, name):
    return [r[name] for r in df.orderBy("sensor_id", "timestamp").collect()]


GAPS = [None, 1, None, None, None, 2, None, None, None, None, 3, None]


@pytest.mark.parametrize("block_rows", [None, 5])
def test_short_gaps(spark, block_rows):
    out = clean.gap_fill_short(readings(spark, GAPS), block_rows=block_rows)
    assert column(out, "reading_value") == [None, 1, 1, 1, 1, 2, None, None, None, None, 3, 3]
    assert column(out, "is_imputed") == [1, 0, 1, 1, 1, 0, 0, 0, 0, 0, 0, 1]


@pytest.mark.parametrize("max_gap", [1, 2, 4])
def test_gap_limit(spark, max_gap):
    rng = np.random.default_rng(max_gap)
    values = [None if rng.random() < 0.6 else float(i) for i in range(200)]
    out = clean.gap_fill_short(readings(spark, values), max_gap=max_gap)
    s = pd.Series(values, dtype="float64")
    run = s.isna().ne(s.isna().shift()).cumsum()
    short = s.isna() & (s.isna().groupby(run).transform("sum") <= max_gap)
    expected = s.where(~short, s.ffill())
    got = pd.Series(column(out, "reading_value"), dtype="float64")
    pd.testing.assert_series_equal(got, expected, check_names=False)
    assert column(out, "is_imputed") == short.astype(int).tolist()


def test_runs(spark):
    out = clean.missing_runs(readings(spark, GAPS))
    assert column(out, "run_id") == [1, 2, 3, 3, 3, 4, 5, 5, 5, 5, 6, 7]
    assert column(out, "gap_size") == [1, 0, 3, 3, 3, 0, 4, 4, 4, 4, 0, 1]


@pytest.mark.parametrize("values,expected", [
    ((2, 4, None, 6), [0, 0.5, None, 1]), ((5, 5, None), [0, 0, 0]), ((None, None), [0, 0]),
])
def test_minmax(spark, values, expected):
    assert column(clean.minmax_normalize(readings(spark, values)), "reading_normalized") == expected


def test_later_feed_wins_even_with_null(spark):
    early = readings(spark, [10], source="http_stream", priority=1, seq=5)
    late = readings(spark, [None], source="mqtt_stream", priority=2, seq=1)
    row = clean.dedup_keep_last(late.unionByName(early)).first()
    assert row["reading_value"] is None and row["source"] == "mqtt_stream"


def test_last_line_wins_within_a_feed(spark):
    rows = readings(spark, [1], priority=1, seq=1).unionByName(readings(spark, [2], priority=1, seq=2))
    assert clean.dedup_keep_last(rows).first()["reading_value"] == 2


def test_null_keys_are_dropped(spark):
    rows = spark.createDataFrame([(None, 1), ("S01", None), ("S01", 1)], "sensor_id string, t int")
    rows = rows.select("sensor_id", F.timestamp_seconds("t").alias("timestamp"), F.lit(1).alias("seq"))
    assert clean.drop_null_keys(rows).count() == 1
    assert clean.dedup_keep_last(rows, order=("seq",)).count() == 1


def test_dedup_collapses_a_hot_key_before_the_shuffle(spark):
    rows = spark.range(0, 20000, numPartitions=4).select(
        F.lit("S01").alias("sensor_id"), F.timestamp_seconds(F.lit(0)).alias("timestamp"),
        F.col("id").cast("float").alias("reading_value"), F.col("id").alias("seq"))
    out = clean.dedup_keep_last(rows, order=("seq",))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
    assert [r["seq"] for r in out.collect()] == [19999]


def test_rolling_matches_pandas(spark):
    rng = np.random.default_rng(7)
    values = [None if rng.random() < 0.15 else round(float(rng.normal(50, 4)), 2) for _ in range(300)]
    s = pd.Series(values, dtype="float32").astype("float64")
    out = windows.rolling_stats(readings(spark, values))
    for name, want in {
        "rolling_avg": s.rolling(30, min_periods=1).mean(), "moving_std": s.rolling(30, min_periods=2).std(),
        "rolling_min": s.rolling(30, min_periods=1).min(), "rolling_max": s.rolling(30, min_periods=1).max(),
    }.items():
        np.testing.assert_allclose(np.array(column(out, name), dtype=float), want.to_numpy(), atol=1e-7)
    cleaned = windows.rolling_stats(readings(spark, values), min_mean=5, min_std=5)
    want = s.rolling(30, min_periods=5).std()
    np.testing.assert_allclose(np.array(column(cleaned, "moving_std"), dtype=float), want.to_numpy(), atol=1e-7)


def test_constant_series_has_no_peaks(spark):
    out = windows.window_features(readings(spark, [0.1] * 40))
    assert set(column(out, "peak_frequency")) == {0}
    assert set(column(out, "z_score")) == {0.0}
    assert set(column(out, "stability_score")) == {1.0}


def test_feature_bounds(spark):
    rng = np.random.default_rng(11)
    values = list(rng.normal(0, 1, 400))
    values[200] = 60.0
    values[13] = 500.0
    both = readings(spark, values).unionByName(readings(spark, [3, None, 4], sensor="S02"))
    cleaned = clean.clean_windows(both)
    out = windows.window_features(cleaned).toPandas().sort_values(["sensor_id", "timestamp"])
    assert (out["outlier_flag"] == out["anomaly_flag"]).all()
    s1 = out[out["sensor_id"] == "S01"].reset_index(drop=True)
    # Fewer than 15 samples cannot reach 3.5 deviations, however far off the reading is.
    assert s1.loc[13, "anomaly_flag"] == 0 and s1.loc[200, "anomaly_flag"] == 1
    assert out["z_score"].abs().max() <= 29 / np.sqrt(30) + 1e-9
    assert out["stability_score"].between(0, 1).all() and (out["stability_score"] > 0).all()
    assert out["peak_frequency"].between(0, 30).all()
    assert (out["rolling_min"] <= out["rolling_avg"] + 1e-9).all()
    assert (out["rolling_avg"] <= out["rolling_max"] + 1e-9).all()
    assert len(out) == 403


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ansi_mode_does_not_matter(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        out = windows.window_features(clean.clean_windows(readings(spark, [1, 1, 1, None, 2])))
        assert column(out, "anomaly_flag") == [0] * 5
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_partitioning_does_not_matter(spark, partitions):
    rng = np.random.default_rng(3)
    df = readings(spark, list(rng.normal(0, 1, 150))).repartition(partitions)
    out = windows.window_features(clean.clean_windows(df)).orderBy("timestamp")
    got = [tuple(r) for r in out.select("rolling_avg", "moving_std", "peak_frequency").collect()]
    base = windows.window_features(clean.clean_windows(df.coalesce(1))).orderBy("timestamp")
    assert got == [tuple(r) for r in base.select("rolling_avg", "moving_std", "peak_frequency").collect()]
