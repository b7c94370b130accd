import numpy as np
import pytest

from fumarole.operators.quantile_states import QuantileStates

PROBS = [0.0, 0.25, 0.5, 0.97, 1.0]


def table(spark, days, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for day, (n, shift) in days.items():
        for x in rng.normal(shift, 1, n):
            rows.append((day, None if rng.random() < 0.05 else float(x), float(rng.integers(0, 3)), float("nan")))
    return spark.createDataFrame(rows, "reading_date string, x double, few double, never double").repartition(4)


def plain(df, columns=("x", "few", "never")):
    held = df.toPandas()
    return {c: [None] * len(PROBS) if held[c].isna().all() else np.quantile(held[c].dropna(), PROBS).tolist() for c in columns}


def same(got, want):
    for c, values in want.items():
        assert got[c] == (values if None in values else pytest.approx(values, rel=1e-12)), c


def test_states_equal_the_whole_table(spark, tmp_path):
    days = {f"2025-01-{d:02d}": (800, 0.0) for d in range(1, 8)}
    all_ = table(spark, days).cache()
    states, asked = QuantileStates(spark, str(tmp_path), ["x", "few", "never"], PROBS), []

    def rows(upto):
        asked.append(upto)
        return all_.where(f"reading_date <= '{upto}'")

    states.add(all_.where("reading_date <= '2025-01-04'"))
    for upto in ("2025-01-04", "2025-01-05", "2025-01-07"):
        if upto > "2025-01-04":
            states.add(all_.where(f"reading_date > '2025-01-04' and reading_date <= '{upto}'"))
        same(states.quantiles(lambda: rows(upto)), plain(all_.where(f"reading_date <= '{upto}'")))
    # Added days, and one that came twice, are not read with the others again.
    assert asked == ["2025-01-04"]
    assert states._read("counts-1", "q int").count() == 7 * 2 * len(PROBS)


def test_a_drift_draws_brackets_anew(spark, tmp_path):
    days = {"2025-01-01": (500, 0.0), "2025-01-02": (3000, 5.0), "2025-01-03": (10, -50.0)}
    all_ = table(spark, days, 2).cache()
    states = QuantileStates(spark, str(tmp_path), ["x"], PROBS)
    for day in days:
        states.add(all_.where(f"reading_date = '{day}'"))
        upto = all_.where(f"reading_date <= '{day}'")
        same(states.quantiles(lambda: upto), plain(upto, ["x"]))
    assert states.version >= 2


def test_no_values(spark, tmp_path):
    states = QuantileStates(spark, str(tmp_path), ["never"], PROBS)
    rows = table(spark, {"2025-01-01": (5, 0.0)})
    states.add(rows)
    assert states.quantiles(lambda: rows) == {"never": [None] * len(PROBS)}
