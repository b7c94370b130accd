import numpy as np
import pytest
from pyspark.sql import functions as F

from fumarole.operators import model
from fumarole.settings import MODEL_FEATURES


def features(spark, n, planted=5, partitions=4):
    """Normal rows, and ``planted`` ones far away in every feature."""
    rows = spark.range(0, n, numPartitions=partitions)
    far = F.when(F.col("id") < planted, F.lit(40.0)).otherwise(F.lit(0.0))
    cols = [(F.randn(k) + far).alias(c) for k, c in enumerate(MODEL_FEATURES)]
    out = rows.select(
        F.concat(F.lit("S"), F.pmod("id", F.lit(4))).alias("sensor_id"),
        F.timestamp_seconds(F.col("id") * 60).alias("timestamp"), "id", *cols)
    # The random columns depend on the partitioning: fix them.
    return spark.createDataFrame(out.toArrow())


@pytest.fixture(scope="module")
def rows(spark):
    return features(spark, 3000)


@pytest.fixture(scope="module")
def nodes(rows):
    return model.fit_iforest(rows, n_trees=40, psi=64).cache()


def test_matrix_has_no_gaps(spark):
    df = spark.createDataFrame(
        [("S01", 0, float("nan"), None, float("inf"))], "sensor_id string, timestamp int, a double, b double, c double")
    assert model.model_matrix(df, ("a", "b", "c")).select("a", "b", "c").first()[:] == (0, 0, 0)


def test_tree_shape(nodes):
    table = nodes.toPandas()
    assert table["tree_id"].nunique() == 40
    assert table["depth"].max() <= 6
    leaves = table[table["feature"] < 0]
    assert (leaves.groupby("tree_id")["size"].sum() == 64).all()
    inner = table[table["feature"] >= 0].merge(
        table.add_prefix("l_"), left_on=["tree_id", "left"], right_on=["l_tree_id", "l_node_id"]
    ).merge(table.add_prefix("r_"), left_on=["tree_id", "right"], right_on=["r_tree_id", "r_node_id"])
    assert len(inner) == (table["feature"] >= 0).sum()
    assert (inner["l_size"] + inner["r_size"] == inner["size"]).all()
    assert (inner["l_size"] > 0).all() and (inner["r_size"] > 0).all()


def test_scores_rank_planted_rows_highest(rows, nodes):
    scored = model.score_iforest(rows, nodes).toPandas()
    assert scored["anomaly_score"].between(0, 1).all() and (scored["anomaly_score"] > 0).all()
    assert set(scored.nlargest(5, "anomaly_score")["id"]) == set(range(5))


def test_score_is_the_published_formula(rows, nodes):
    """One row walked through every tree by hand."""
    row = rows.where("id = 17").toPandas()
    table = nodes.toPandas()

    def c(n):
        return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    depths = []
    for _, t in table.groupby("tree_id"):
        t = t.set_index("node_id")
        at = 0
        while t.loc[at, "feature"] >= 0:
            value = row[MODEL_FEATURES[t.loc[at, "feature"]]].iloc[0]
            at = t.loc[at, "left"] if value <= t.loc[at, "threshold"] else t.loc[at, "right"]
        depths.append(t.loc[at, "depth"] + c(t.loc[at, "size"]))
    got = model.score_iforest(rows.where("id = 17"), nodes).first()["anomaly_score"]
    assert got == pytest.approx(2 ** (-np.mean(depths) / c(64)))


def test_forest_does_not_depend_on_partitioning(rows, nodes):
    again = model.fit_iforest(rows.repartition(7), n_trees=40, psi=64)
    key = ["tree_id", "node_id"]
    assert again.orderBy(key).collect() == nodes.orderBy(key).collect()


def test_few_rows_share_them_among_trees(spark):
    few = features(spark, 300)
    table = model.fit_iforest(few, n_trees=10, psi=256).toPandas()
    assert (table[table["depth"] == 0]["size"] == 256).all()
    fewer = model.fit_iforest(few.limit(20), n_trees=10, psi=256).toPandas()
    assert (fewer[fewer["depth"] == 0]["size"] == 20).all()


def test_single_row_and_constant_rows(spark):
    same = spark.range(1).select(
        F.lit("S01").alias("sensor_id"), F.timestamp_seconds("id").alias("timestamp"),
        *[F.lit(1.0).alias(c) for c in MODEL_FEATURES])
    forest = model.fit_iforest(same, n_trees=3)
    assert 0 < model.score_iforest(same, forest).first()["anomaly_score"] <= 1


@pytest.mark.parametrize("small", [True, False])
def test_contamination_share(rows, nodes, small):
    scored = model.score_iforest(rows, nodes)
    flagged = model.flag_top(scored, small=small)
    scores = np.array([r[0] for r in scored.select("anomaly_score").collect()])
    assert flagged.where("ml_anomaly = 1").count() == (scores > np.quantile(scores, 0.97)).sum()


def test_alerts_newest_first(rows):
    flagged = rows.withColumns({"ml_anomaly": (F.col("id") < 4).cast("int"), "anomaly_score": F.lit(0.9)})
    out = model.alerts(flagged)
    assert out.columns == ["timestamp", "sensor_id", "reading_value", "z_score", "anomaly_score", "alert"]
    times = [r["timestamp"] for r in out.collect()]
    assert len(times) == 4 and times == sorted(times, reverse=True)
    assert {r["alert"] for r in out.collect()} == {"SENSOR_ANOMALY"}


def test_one_sampling_rule_at_any_size(spark):
    """A row more changes a tree's sample by that row at most; a key shared by all rows is no trap."""
    def samples(n, key="id"):
        rows = spark.range(n).selectExpr(f"{key} as k", "id")
        found = model._sampled(rows, n, 5, 6, 1, ["k"]).select("tree_id", "id").collect()
        return {t: {r["id"] for r in found if r["tree_id"] == t} for t in range(5)}

    for n in (29, 59, 2000):
        less, more = samples(n), samples(n + 1)
        assert all(len(less[t]) == 6 and more[t] - less[t] <= {n} for t in range(5))
    assert all(len(s) in (0, 6) for s in samples(3000, "0").values())
