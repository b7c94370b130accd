"""Whole-history values on a stream, under versions of the history's statistics.

Per sensor the extremes, the sum and the number of its readings are kept, which merge with those of
later rows; beside them stands the cut that flags scores. Every update is a new version, complete or not
there. A micro-batch is scored under the version that is current when it is first run and notes it, so a
batch that is run again gives the same rows; each row tells its version.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fumarole.operators.cross import NORMALIZED, cross_features
from fumarole.plans.sizing import lookup
from fumarole.settings import SENSOR, VALUE
from fumarole.sinks import versions

PARTS = f"{SENSOR} string, lo double, hi double, total double, n long, cut double"


def update_statistics(spark: SparkSession, folder: str, rows: DataFrame, cut: float | None = None, keep: int = 10) -> str:
    """Merge readings that no version has seen yet into a new version; returns its name.

    ``cut`` replaces the one so far unless it is None. Only ``rows`` and the last version are read.
    The ``keep`` newest versions stay, for batches that may be run again.
    """
    x = F.col(VALUE).cast("double")
    new = rows.groupBy(SENSOR).agg(
        F.min(x).alias("lo"), F.max(x).alias("hi"), F.sum(x).alias("total"), F.count(x).alias("n"))
    new = new.withColumn("cut", F.lit(cut).cast("double"))
    if versions.versions(spark, folder):
        new = new.unionByName(statistics(spark, folder))
    merged = new.groupBy(SENSOR).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("cut").alias("cut"))
    if cut is not None:
        merged = merged.withColumn("cut", F.lit(float(cut)))
    return versions.replace(spark, folder, lambda path: merged.write.parquet(path), keep).rsplit("/", 1)[-1]


def statistics(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    path = versions.current(spark, folder) if version is None else f"{folder}/{version}"
    return spark.read.schema(PARTS).parquet(path)


def scored(rows: DataFrame, stats: DataFrame, score: str | None = None) -> DataFrame:
    """``rows`` with reading_normalized, the features across sensors and, of ``score``, ml_anomaly.

    As in batch, but with extremes, mean levels and cut of ``stats``. A reading beyond the extremes is
    scaled beyond 0 or 1; a sensor without statistics or variation has 0. The features across sensors
    are those of the instants in ``rows``, so rows of an instant should come together.
    """
    spread = F.col("hi") - F.col("lo")
    x = F.col(VALUE).cast("double")

    def scale(v):
        return F.when(spread != 0, (v - F.col("lo")) / F.nullif(spread, F.lit(0.0))).otherwise(F.lit(0.0))

    joined = lookup(rows, stats, [SENSOR]).withColumn(NORMALIZED, scale(x))
    if score is not None:
        joined = joined.withColumn("ml_anomaly", F.coalesce(F.col(score) > F.col("cut"), F.lit(False)).cast("int"))
    levels = stats.select(SENSOR, scale(F.col("total") / F.nullif(F.col("n"), F.lit(0))).alias("_mean"))
    return cross_features(joined.drop("lo", "hi", "total", "n", "cut"), NORMALIZED, levels)


def score_batches(
    rows: DataFrame, folder: str, target: str, checkpoint: str, score: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Append every micro-batch to ``target``, scored under the statistics in ``folder``, with statistics_version."""
    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        used = f"{checkpoint}/used/{number}"
        noted = versions.versions(spark, used)
        version = noted[0] if noted else versions.versions(spark, folder)[-1]
        versions.commit(spark, used, version)
        out = scored(batch, statistics(spark, folder, version), score).withColumn("statistics_version", F.lit(version))
        out.write.mode("overwrite").parquet(f"{target}/batch_no={number}")

    return (
        rows.writeStream.foreachBatch(step).option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(**(trigger or {"availableNow": True})).start()
    )
