"""Mean correlation of every instant with all instants, without pairs of instants.

The correlation of two instants over the sensors that both have is the dot product of their readings
there, standardised over just these sensors. All instants with the same presence mask share that set
with all instants of another mask. So an instant's sum of correlations with a whole mask is one dot
product with the sum of the other mask's standardised rows, and sums of masks that leave the same
common sensors add up. Work grows with instants times different common sets, not with pairs of
instants. Masks meet in a join over their sensors; the instants of a mask are dealt into blocks, so a
mask that holds most of the instants, as with complete data, is many tasks.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumarole.operators.cross import NORMALIZED
from fumarole.plans.sizing import lookup, stored
from fumarole.settings import SENSOR, TIME

BLOCK_INSTANTS = 100_000
PART = ["mask", "block"]


def standardised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows centred and of length one, and which rows vary at all; the others are zero."""
    x = x - x[:, :1]  # equal values leave exact zeros
    varies = (x != 0).any(axis=1)
    x = x - x.mean(axis=1, keepdims=True)
    length = np.sqrt((x * x).sum(axis=1))
    varies &= length > 0
    return np.where(varies[:, None], x / np.where(varies, length, 1.0)[:, None], 0.0), varies


def instant_similarity(df: DataFrame, value: str = NORMALIZED, block_instants: int = BLOCK_INSTANTS) -> DataFrame:
    """Per instant with any value: the mean of its correlations with all instants, itself included.

    Correlations are taken over the sensors that both instants have; undefined ones, of fewer than
    two sensors or without variation, do not count. Null where none is defined. Rows must be unique
    per sensor and instant, see ``cross.cell_means``; null and NaN readings are missing ones.
    """
    x = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    cells = df.select(TIME, SENSOR, x.alias("x")).where(F.col("x").isNotNull() & F.col(SENSOR).isNotNull())
    rows = cells.groupBy(TIME).agg(F.sort_array(F.collect_list(F.struct(SENSOR, "x"))).alias("cells"))
    instants = stored(rows.select(TIME, F.col(f"cells.{SENSOR}").alias("sensors"), F.col("cells.x").alias("x")), "instants")
    blocks = F.ceil(F.count(F.lit(1)) / block_instants).cast("int")
    masks = stored(instants.groupBy("sensors").agg(blocks.alias("blocks")).withColumn("mask", F.monotonically_increasing_id()), "masks")

    has = masks.select("mask", F.explode("sensors").alias("sensor"))
    both = has.join(has.withColumnRenamed("mask", "other"), "sensor").groupBy("mask", "other")
    pairs = stored(both.agg(F.sort_array(F.collect_list("sensor")).alias("common")).where(F.size("common") > 1), "mask_pairs")

    def in_blocks(of_mask: DataFrame) -> DataFrame:
        each = masks.select("mask", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        return of_mask.join(each, "mask")

    block = F.pmod(F.xxhash64(TIME), F.col("blocks")).cast("int")
    dealt = lookup(instants, masks, ["sensors"]).withColumn("block", block).select(*PART, TIME, "sensors", "x")
    dealt = stored(dealt, "instant_blocks")

    def sums(rows: pd.DataFrame, commons: pd.DataFrame) -> pd.DataFrame:
        out = []
        for common, u, varies in _restricted(rows, commons["common"]):
            total = u.sum(axis=0)
            out += [(commons["mask"].iloc[0], common, k, total[k], int(varies.sum())) for k in range(len(common))]
        return pd.DataFrame(out, columns=["other", "common", "k", "total", "n"])

    kinds = dict(dealt.dtypes)
    commons = in_blocks(pairs.select("mask", "common").distinct())
    parts = dealt.groupBy(*PART).cogroup(commons.groupBy(*PART)).applyInPandas(
        sums, f"other long, common {kinds['sensors']}, k int, total double, n long")
    parts = parts.groupBy("other", "common", "k").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    vectors = (pairs.join(parts, ["other", "common"]).groupBy("mask", "common", "k")
               .agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    vectors = (vectors.groupBy("mask", "common").agg(F.sort_array(F.collect_list(F.struct("k", "total"))).alias("totals"), F.max("n").alias("n"))
               .select("mask", "common", F.col("totals.total").alias("totals"), "n"))

    def means(rows: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        total, n = np.zeros(len(rows)), np.zeros(len(rows))
        if len(rows):
            for (_, u, varies), t, count in zip(_restricted(rows, vectors["common"]), vectors["totals"], vectors["n"]):
                total += u @ np.asarray(t)
                n += np.where(varies, count, 0)
        mean = np.divide(total, n, out=np.full(len(rows), np.nan), where=n > 0)
        return pd.DataFrame({TIME: rows[TIME], "similarity": mean})

    found = dealt.groupBy(*PART).cogroup(in_blocks(vectors).groupBy(*PART)).applyInPandas(means, f"{TIME} {kinds[TIME]}, similarity double")
    return found.select(TIME, F.nanvl("similarity", F.lit(None).cast("double")).alias("instant_similarity"))


def _restricted(rows: pd.DataFrame, commons: pd.Series):
    """For every common set: its sensors, the standardised rows on them, and which rows vary."""
    if not len(rows):
        return
    x = np.stack(rows["x"].to_numpy())
    at = {s: k for k, s in enumerate(rows["sensors"].iloc[0])}
    for common in commons:
        yield common, *standardised(x[:, [at[s] for s in common]])
