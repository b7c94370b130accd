import datetime as dt

import numpy as np
import pandas as pd
import pytest

from fumarole.operators import similarity

START = dt.datetime(2025, 1, 1)


def cells(spark, x):
    rows = [(START + dt.timedelta(minutes=i), f"S{j}", None if np.isnan(v) else float(v)) for i, row in enumerate(x) for j, v in enumerate(row)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, sensor_id string, reading_normalized double").repartition(5)


def plain(x):
    with np.errstate(all="ignore"):
        corr = pd.DataFrame(x).T.corr()
    return corr.mean(axis=1).to_numpy()


def found(spark, x, **options):
    got = {r[0]: r[1] for r in similarity.instant_similarity(cells(spark, x), **options).collect()}
    return [got.get(START + dt.timedelta(minutes=i), "none") for i in range(len(x))]


@pytest.mark.parametrize("gaps, block", [(0.0, 7), (0.25, 100_000), (0.6, 2)])
def test_equals_the_matrix_of_all_instants(spark, gaps, block):
    rng = np.random.default_rng(int(gaps * 100))
    x = rng.integers(0, 6, (70, 7)) / 5
    x[rng.random(x.shape) < gaps] = np.nan
    x[3], x[4] = 0.1, np.nan  # without variation, and without any value
    x[5, 1:] = np.nan
    got = found(spark, x, block_instants=block)
    for mine, want, row in zip(got, plain(x), x):
        if np.isnan(row).all():
            assert mine == "none"
        elif np.isnan(want):
            assert mine is None
        else:
            assert mine == pytest.approx(want, abs=1e-12)


def test_complete_data_has_one_mask(spark):
    x = np.random.default_rng(5).normal(size=(400, 16))
    assert found(spark, x, block_instants=64) == pytest.approx(plain(x), abs=1e-12)


def test_no_cells(spark):
    assert similarity.instant_similarity(cells(spark, np.full((3, 2), np.nan))).count() == 0
