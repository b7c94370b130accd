import numpy as np
import pytest

from fumarole.operators import quantiles

PROBS = [0.0, 0.03, 0.25, 0.5, 0.75, 0.97, 1.0]


def samples():
    rng = np.random.default_rng(5)
    n = 5000
    heavy = np.where(rng.random(n) < 0.9, 0.0, rng.normal(0, 1, n))
    flag = (rng.random(n) < 0.02).astype(float)
    wide = rng.normal(0, 1, n) * 10.0 ** rng.integers(-200, 200, n)
    gaps = rng.normal(0, 1, n)
    gaps[rng.random(n) < 0.3] = np.nan
    return {"heavy": heavy, "flag": flag, "wide": wide, "gaps": gaps, "none": np.full(n, np.nan)}


@pytest.fixture(scope="module")
def table(spark):
    data = samples()
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in zip(*data.values())]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(6).cache()


@pytest.mark.parametrize("small", [True, False])
def test_exact_quantiles(table, small):
    data = samples()
    got = quantiles.exact_quantiles(table, list(data), PROBS, small=small)
    for c, x in data.items():
        x = x[~np.isnan(x)]
        if not len(x):
            assert got[c] == [None] * len(PROBS)
            continue
        np.testing.assert_allclose(got[c], np.quantile(x, PROBS), rtol=1e-12)


def test_odd_numbers_count_alike_at_any_size(spark):
    numbers = [float(i) for i in range(10)] + [float("nan")] * 3 + [float("inf"), float("-inf"), -0.0, None]
    rows = spark.createDataFrame([(v, float("nan"), float("inf")) for v in numbers], "x double, n double, i double")
    got = [quantiles.exact_quantiles(rows, ["x", "n", "i"], PROBS, small=s) for s in (True, False)]
    assert got[0] == got[1]
    assert got[0]["x"][3] == 4.0 and got[0]["n"] == [None] * len(PROBS) and got[0]["i"] == [float("inf")] * len(PROBS)


def test_order_statistics_narrow_to_the_value(table):
    """A coarse sketch and a tiny bracket force several rounds."""
    data = samples()
    ranks = {0, 1, 700, 2500, 4500, 4998, 4999}
    for c in ("heavy", "flag", "wide"):
        values = table.selectExpr(f"{c} as x")
        got = quantiles.order_statistics(values, ranks, 5000, accuracy=20, bracket_rows=5)
        assert got == {r: np.sort(data[c])[r] for r in ranks}


def test_describe_is_the_same_at_any_size(table):
    a, b = (quantiles.describe(table, ["heavy", "gaps"], small=s).orderBy("feature").collect() for s in (True, False))
    for x, y in zip(a, b):
        assert x["feature"] == y["feature"] and x["count"] == y["count"]
        assert list(x[2:]) == pytest.approx(list(y[2:]))


@pytest.mark.parametrize("odd", [[], [float("nan")] * 3, [float("inf")], [float("-inf"), float("inf"), float("nan"), None], [0.0, -0.0]])
def test_describe_skips_nan_at_any_size(spark, odd):
    x = [float(i) for i in range(10)] + odd
    rows = spark.createDataFrame([(v, -1.0 if v is None else v) for v in x], "x double, y double")
    small, large = (quantiles.describe(rows, ["x", "y"], small=s).orderBy("feature").collect() for s in (True, False))
    assert repr(small) == repr(large)
    kept = np.array([v for v in x if v is not None and not np.isnan(v)])
    assert small[0]["count"] == len(kept)
    for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
        at = p * (len(kept) - 1)
        low, high = np.sort(kept)[int(np.floor(at))], np.sort(kept)[int(np.ceil(at))]
        assert small[0][name] == (low if low == high else pytest.approx(low + (high - low) * (at % 1)))


def test_all_columns_share_their_passes(table, monkeypatch):
    """Passes depend on the rounds, not on the number of columns."""
    calls = []
    for name in ("_sketch", "_locate", "_read_brackets"):
        real = getattr(quantiles, name)
        monkeypatch.setattr(quantiles, name, lambda *a, real=real, name=name: calls.append(name) or real(*a))
    data = samples()
    want = {c: x[~np.isnan(x)] for c, x in data.items() if not np.isnan(x).all()}
    ranks = {c: ({0, len(x) // 2, len(x) - 1}, len(x)) for c, x in want.items()}
    got = quantiles.column_order_statistics(quantiles.numbers(table, list(want)), ranks, accuracy=100, bracket_rows=300)
    assert got == {c: {r: np.sort(want[c])[r] for r in ranks[c][0]} for c in want}
    assert calls.count("_sketch") == calls.count("_locate") <= 2 and calls.count("_read_brackets") == 1
