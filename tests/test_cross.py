import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fumarole.functions import guarded_corr
from fumarole.operators import cross
from fumarole.plans import sizing


def matrix(spark, x, names=None):
    t, s = x.shape
    names = names or [f"S{k + 1:02d}" for k in range(s)]
    rows = [(names[j], i, None if np.isnan(x[i, j]) else float(x[i, j])) for i in range(t) for j in range(s)]
    df = spark.createDataFrame(rows, "sensor_id string, i int, reading_value double")
    return df.select("sensor_id", F.timestamp_seconds(F.col("i") * 60).alias("timestamp"), "reading_value")


def noisy(t=60, s=5, seed=0, gaps=0.2):
    rng = np.random.default_rng(seed)
    x = rng.normal(1000, 5, (t, s)) + np.arange(t)[:, None] * rng.normal(0, 1, s)
    x[rng.random((t, s)) < gaps] = np.nan
    x[3] = np.nan
    x[:, s - 1] = np.where(np.isnan(x[:, s - 1]), np.nan, 0.1)
    return x


def test_guarded_correlation(spark):
    def corr(pairs):
        pairs = [[None if v is None else float(v) for v in p] for p in pairs]
        df = spark.createDataFrame(pairs, "x double, y double")
        return df.agg(guarded_corr(F.col("x"), F.col("y"))).first()[0]

    assert corr([(1, 1), (1, 2)]) is None
    assert corr([(1, 2), (2, 5)]) == pytest.approx(1)
    assert corr([(1, 2)]) is None
    assert corr([(1, 2), (None, 9), (2, 1), (3, None)]) == pytest.approx(-1)


def test_sensor_correlation_against_pandas(spark):
    x = noisy()
    pivot = pd.DataFrame(x)
    mean = pivot.mean(axis=0)
    want = {}
    for i, row in pivot.iterrows():
        ok = row.notna()
        if ok.any():
            c = row[ok].corr(mean[ok]) if ok.sum() >= 2 else 0.0
            want[i * 60] = 0.0 if np.isnan(c) else c
    out = cross.sensor_correlation(matrix(spark, x), "reading_value")
    got = {r[0]: r[1] for r in out.select(F.unix_seconds("timestamp"), "sensor_correlation").collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9)


@pytest.mark.parametrize("tile", [256, 2])
def test_correlation_matrix_against_pandas(spark, tile):
    x = noisy(seed=1)
    want = pd.DataFrame(x).corr().to_numpy()
    out = cross.correlation_matrix(matrix(spark, x).repartition(7), tile=tile).collect()
    assert len(out) == 25
    for r in out:
        expected = want[int(r["sensor_a"][1:]) - 1, int(r["sensor_b"][1:]) - 1]
        if np.isnan(expected):
            assert r["correlation"] is None
        else:
            assert r["correlation"] == pytest.approx(expected, abs=1e-9)


def test_empty_instants_leave_the_pivot(spark):
    x = noisy(seed=2)
    out = cross.pivot_mean(matrix(spark, x), [f"S{k:02d}" for k in range(1, 6)])
    assert out.count() == 59


def test_every_row_gets_its_instant(spark):
    x = noisy(seed=4)
    df = matrix(spark, x).withColumnRenamed("reading_value", "reading_normalized")
    out = cross.cross_features(df)
    assert out.count() == df.count()
    empty = out.where(F.unix_seconds("timestamp") == 180).collect()
    assert {r["sensor_correlation"] for r in empty} == {0.0}
    assert {r["gas_concentration_est"] for r in empty} == {None}


def test_lookups_beyond_the_bound_give_the_same(spark, monkeypatch):
    df = matrix(spark, noisy(seed=5)).withColumnRenamed("reading_value", "reading_normalized")
    small = sorted(map(tuple, cross.cross_features(df).collect()), key=repr)
    monkeypatch.setattr(cross, "small_side", lambda stats: None)
    monkeypatch.setattr(sizing, "small_side", lambda *a: None)
    spread = cross.cross_features(df)
    assert "_salt" in spread._jdf.queryExecution().optimizedPlan().toString()
    large = sorted(map(tuple, spread.collect()), key=repr)
    assert len(small) == len(large)
    for a, b in zip(small, large):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], nan_ok=True)


def test_bounded_rows(spark):
    assert sizing.bounded_rows(spark.range(100), 99) is None
    assert sizing.bounded_rows(spark.range(100), 100).count() == 100
    big = spark.range(10_000_000_000)
    assert not sizing.is_small(big)
    joined = sizing.lookup(spark.range(5), big.where("id < 3").withColumn("v", F.lit(1)), ["id"])
    assert joined.where("v = 1").count() == 3


def test_sensors_that_never_meet(spark):
    x = noisy(seed=6, gaps=0.0)
    x[::2, 0] = np.nan
    x[1::2, 1] = np.nan
    out = cross.correlation_matrix(matrix(spark, x))
    pair = out.where("sensor_a = 'S01' and sensor_b = 'S02'").first()
    assert pair["correlation"] is None and out.count() == 25


@pytest.mark.parametrize("tile, block_rows", [(3, 60), (1, 40), (256, 25)])
def test_matrix_by_tiles_and_blocks(spark, tile, block_rows):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(90, 11)) + rng.normal(size=(90, 1))
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 4] = 2.5
    df = matrix(spark, x)
    twice = df.unionByName(df.where(F.col("reading_value") > 0))  # a cell's mean stays what it is
    got = {(r[0], r[1]): r[2] for r in cross.correlation_matrix(twice, tile=tile, block_rows=block_rows).collect()}
    names = sorted({a for a, _ in got})
    want = pd.DataFrame(x, columns=names).corr().to_numpy()
    assert len(got) == len(names) ** 2
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            assert got[a, b] is None if np.isnan(want[i, j]) else got[a, b] == pytest.approx(want[i, j], abs=1e-9)
