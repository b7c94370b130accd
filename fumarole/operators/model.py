"""Isolation forest on Spark: sample and grow per tree, score per row batch."""

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fumarole.functions import finite
from fumarole.operators.quantiles import exact_quantiles
from fumarole.schema import NODES
from fumarole.settings import (
    ALERT, ALERT_COLUMNS, CONTAMINATION, KEYS, MODEL_FEATURES, N_TREES, SEED, SUBSAMPLE,
)


def model_matrix(df: DataFrame, features=tuple(MODEL_FEATURES), keys=KEYS) -> DataFrame:
    """Keys and model features, 0 for missing and non-finite values."""
    return df.select(*keys, *[F.coalesce(finite(F.col(c)), F.lit(0.0)).alias(c) for c in features])


def fit_iforest(
    df: DataFrame, n_trees: int = N_TREES, psi: int = SUBSAMPLE, seed: int = SEED,
    features=tuple(MODEL_FEATURES), keys=KEYS,
) -> DataFrame:
    """Node table of an isolation forest.

    Each tree gets its own ``psi`` rows, picked by the hash of the row key, so the
    forest depends on the rows and the seed but not on how they are partitioned.
    ``df`` is passed over twice: store it first.
    """
    rows = model_matrix(df, features, keys)
    n = rows.count()
    size = min(psi, n)
    sample = _sampled(rows, n, n_trees, psi, seed, keys)
    grow = _grower(list(features), seed, max(1, math.ceil(math.log2(max(size, 2)))))
    # The sample is small in bytes but each tree takes time: keep the trees in separate tasks.
    tasks = min(n_trees, df.sparkSession.sparkContext.defaultParallelism)
    return sample.repartition(tasks, "tree_id").groupBy("tree_id").applyInPandas(grow, NODES)


def _sampled(rows: DataFrame, n: int, n_trees: int, psi: int, seed: int, keys) -> DataFrame:
    """For every tree the ``psi`` rows with its smallest key hashes, by one rule for any ``n``.

    A row is copied only for the trees whose cut its hash is below; the cut leaves a
    tree ``psi`` rows and eight standard deviations more, so few rows are ever sorted. Keys should be unique, as
    dedup leaves them: rows that share one are drawn or passed over together.
    """
    share = min(1.0, (psi + 8 * math.sqrt(psi) + 16) / max(n, 1))
    cut = min(2**63 - 1, int(-(2**63) + share * 2**64))

    def hash_of(tree):
        return F.xxhash64(F.lit(seed), tree, *keys)

    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: hash_of(t) <= F.lit(cut))
    rows = rows.withColumn("tree_id", F.explode(trees)).withColumn("_h", hash_of(F.col("tree_id")))
    rank = F.row_number().over(Window.partitionBy("tree_id").orderBy("_h", *keys))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= psi).drop("_rank")


def _grower(features: list[str], seed: int, height: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree_id"].iloc[0])
        x = sample.sort_values("_h", kind="stable")[features].to_numpy("float64")
        rng = np.random.default_rng([seed, tree])
        nodes: list[list] = []
        todo = [(np.arange(len(x)), 0, None, None)]
        while todo:
            rows, depth, parent, side = todo.pop()
            me = len(nodes)
            if parent is not None:
                nodes[parent][side] = me
            nodes.append([tree, me, -1, 0.0, -1, -1, len(rows), depth])
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            varied = np.flatnonzero(high > low)
            if depth == height or not len(varied):
                continue
            f = int(rng.choice(varied))
            cut = float(rng.uniform(low[f], high[f]))
            goes_left = x[rows, f] <= cut
            if goes_left.all():
                cut, goes_left = float(low[f]), x[rows, f] <= low[f]
            nodes[me][2:4] = [f, cut]
            todo += [(rows[~goes_left], depth + 1, me, 5), (rows[goes_left], depth + 1, me, 4)]
        return pd.DataFrame(nodes, columns=NODES.names)

    return grow


def expected_path(n):
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype="float64")
    big = np.maximum(n, 3)
    path = 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big
    return np.where(n > 2, path, np.where(n == 2, 1.0, 0.0))


def _full_tree(tree: pd.DataFrame, height: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut) of a tree filled up to ``height`` levels, and path lengths of its last level.

    ``tree`` is in ``node_id`` order. Node ``i`` has the children ``2i + 1`` and ``2i + 2``; below a leaf all rows go left.
    """
    inner = 2**height - 1
    split, threshold, left, right = (tree[c].to_numpy() for c in ("feature", "threshold", "left", "right"))
    feature, cut = np.zeros(inner, dtype="int64"), np.full(inner, np.inf)
    node = np.zeros(2 * inner + 1, dtype="int64")
    for level in range(height):
        # All nodes of a level at once; a leaf stands for both of its children.
        here = np.arange(2**level - 1, 2 ** (level + 1) - 1)
        at = node[here]
        inside = split[at] >= 0
        feature[here], cut[here] = np.where(inside, split[at], 0), np.where(inside, threshold[at], np.inf)
        node[2 * here + 1], node[2 * here + 2] = np.where(inside, left[at], at), np.where(inside, right[at], at)
    length = tree["depth"].to_numpy() + expected_path(tree["size"])
    return feature, cut, length[node[inner:]]


def score_iforest(df: DataFrame, nodes: DataFrame, features=tuple(MODEL_FEATURES)) -> DataFrame:
    """Add ``anomaly_score`` in (0, 1]; only the feature columns travel to Python.

    The node table has at most ``2 * psi`` rows per tree, whatever the data.
    """
    table = nodes.orderBy("tree_id", "node_id").toArrow().to_pandas()
    height = int(table["depth"].max()) if len(table) else 0
    trees = [_full_tree(t, height) for _, t in table.groupby("tree_id")]
    psi = table.loc[table["depth"] == 0, "size"].max() if len(table) else 0
    scale = max(float(expected_path(psi)), 1e-12)
    forest = df.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        x, n = np.concatenate([c.to_numpy("float64") for c in cols]), len(cols[0])
        row, path = np.arange(n), np.zeros(n)
        for feature, cut, length in forest.value:
            column = feature * n
            at = np.zeros(n, dtype="int64")
            for _ in range(height):
                right = x.take(column.take(at) + row) > cut.take(at)
                at += at + 1
                at += right
            path += length.take(at - len(cut))
        return pd.Series(np.exp2(-path / max(len(forest.value), 1) / scale))

    inputs = [F.coalesce(finite(F.col(c)), F.lit(0.0)) for c in features]
    return df.withColumn("anomaly_score", score(*inputs))


def flag_top(
    df: DataFrame, score: str = "anomaly_score", contamination: float = CONTAMINATION,
    out: str = "ml_anomaly", small: bool | None = None,
) -> DataFrame:
    """1 for scores strictly above the (1 - contamination) quantile of all scores."""
    return flag_above(df, exact_quantiles(df, [score], [1 - contamination], small)[score][0], score, out)


def flag_above(df: DataFrame, cut: float | None, score: str = "anomaly_score", out: str = "ml_anomaly") -> DataFrame:
    """1 for scores strictly above ``cut``, as of an earlier table or of merged states."""
    above = F.col(score) > F.lit(cut).cast("double")
    return df.withColumn(out, F.coalesce(above, F.lit(False)).cast("int"))


def alerts(df: DataFrame, flag: str = "ml_anomaly", columns=tuple(ALERT_COLUMNS)) -> DataFrame:
    """Flagged rows, newest first."""
    rows = df.where(F.col(flag) == 1).select(*columns, F.lit(ALERT).alias("alert"))
    return rows.orderBy(F.desc("timestamp"), "sensor_id")
