"""Exact keep-last dedup of a stream into a table of buckets.

The table is cut by day and, within a day, into hash buckets of the key. A micro-batch is reduced to
one row per key, joined by what is held of the buckets it touches, and these buckets are written anew
under the number of the batch; all others stay as they are. A manifest per batch tells which batch has
written each bucket last, and is marked complete at the end: a reader sees the table before or after a
batch, and a batch that is run again starts from the one before it and replaces its own files.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fumarole.operators.clean import dedup_keep_last
from fumarole.settings import KEYS, TIME
from fumarole.sinks import versions

BUCKETS = 16
PLACE = ["upsert_day", "upsert_bucket"]
MANIFEST = "upsert_day string, upsert_bucket int, written_by long"


def upsert_batches(
    readings: DataFrame, target: str, checkpoint: str, order=("seq",), keys=KEYS, buckets: int = BUCKETS,
    keep: int = 3, trigger: dict | None = None,
) -> StreamingQuery:
    """Keep ``target`` at one row per key, the last by ``order`` of all batches so far.

    Rows without a key are left out, as in ``dedup_keep_last``. ``order`` decides, whatever batch a
    row came in; rows equal in it are one of them. ``keep`` versions stay readable. ``buckets`` must
    not change while the table lives.
    """
    columns = readings.columns

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        upsert(spark, _placed(dedup_keep_last(batch, keys, order), keys, buckets), target, number, order, keys, columns)
        _forget(spark, target, number, keep)

    return (
        readings.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def _name(number: int) -> str:
    return f"{number:020d}"


def _placed(rows: DataFrame, keys, buckets: int) -> DataFrame:
    return rows.withColumns({
        PLACE[0]: F.date_format(TIME, "yyyy-MM-dd"), PLACE[1]: F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")})


def upsert(spark: SparkSession, rows: DataFrame, target: str, number: int, order, keys, columns: list[str]) -> None:
    """Merge the placed ``rows`` of batch ``number`` into the version before it."""
    before = [v for v in versions.versions(spark, target) if v < _name(number)]
    new = f"{target}/rows/{_name(number)}"
    rows.select(*columns, *PLACE).write.mode("overwrite").parquet(f"{target}/arrived")
    arrived = spark.read.schema(rows.select(*columns, *PLACE).schema).parquet(f"{target}/arrived")
    manifest = spark.createDataFrame([], MANIFEST)
    merged = arrived
    if before:
        manifest = _manifest(spark, target, before[-1])
        # As many rows as buckets that the batch touches.
        touched = manifest.join(arrived.select(*PLACE).distinct(), PLACE, "left_semi").collect()
        held = _read_buckets(spark, target, touched, arrived)
        merged = dedup_keep_last(arrived.unionByName(held), keys, order)
    merged.write.mode("overwrite").partitionBy(*PLACE).parquet(new)
    written = arrived.select(*PLACE).distinct().withColumn("written_by", F.lit(number).cast("long"))
    manifest = manifest.join(written.select(*PLACE), PLACE, "left_anti").unionByName(written)
    manifest.write.mode("overwrite").parquet(f"{target}/manifests/{_name(number)}")
    versions.commit(spark, target, _name(number))


def _manifest(spark: SparkSession, target: str, version: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{target}/manifests/{version}")


def _read_buckets(spark: SparkSession, target: str, buckets: list, like: DataFrame) -> DataFrame:
    """The rows of the buckets that a manifest lists, read folder by folder of the batches."""
    of_batch: dict[int, list[str]] = {}
    for b in buckets:
        path = f"{target}/rows/{_name(b['written_by'])}"
        of_batch.setdefault(b["written_by"], []).append(f"{path}/{PLACE[0]}={b[PLACE[0]]}/{PLACE[1]}={b[PLACE[1]]}")
    rows = spark.createDataFrame([], like.schema)
    for number, paths in of_batch.items():
        part = spark.read.schema(like.schema).option("basePath", f"{target}/rows/{_name(number)}").parquet(*paths)
        rows = rows.unionByName(part)
    return rows


def upserted(spark: SparkSession, target: str, schema) -> DataFrame:
    """The table as the last complete batch has left it; ``schema`` is that of the readings."""
    found = versions.versions(spark, target)
    if not found:
        return spark.createDataFrame([], schema)
    like = spark.createDataFrame([], schema).withColumns({PLACE[0]: F.lit("").cast("string"), PLACE[1]: F.lit(0)})
    return _read_buckets(spark, target, _manifest(spark, target, found[-1]).collect(), like).drop(*PLACE)


def _forget(spark: SparkSession, target: str, number: int, keep: int) -> None:
    """Drop older versions than the ``keep`` last, and batches of which they hold no bucket."""
    found = versions.versions(spark, target)
    for old in found[:-keep]:
        versions.remove(spark, f"{target}/{versions.MARKERS}/{old}")
        versions.remove(spark, f"{target}/manifests/{old}")
    live: set[str] = set()
    for version in found[-keep:]:
        live |= {_name(r["written_by"]) for r in _manifest(spark, target, version).select("written_by").distinct().collect()}
    for old in versions.names(spark, f"{target}/rows"):
        if old not in live and old < _name(number):
            versions.remove(spark, f"{target}/rows/{old}")
