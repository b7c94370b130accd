"""Continuous ingest of landed JSON messages into a log of long readings."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fumarole.operators.clean import dedup_keep_last
from fumarole.schema import CORRUPT, message_schema
from fumarole.settings import FEEDS, KEYS, SENSORS
from fumarole.sources.readers import message_frame
from fumarole.sources.reshape import wide_to_long

# Where a message stands among all messages: feed, then arrival, then line.
ARRIVAL = ("priority", "batch", "arrived_at", "path", "split_at", "line")


def message_stream(spark: SparkSession, landing: str, channels=tuple(SENSORS), files_per_batch=None) -> DataFrame:
    """Messages from files as they land; blank lines skipped, bad lines kept apart."""
    reader = spark.readStream.schema(message_schema(channels))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(landing).select("*", "_metadata")


def ingest_messages(
    messages: DataFrame, target: str, checkpoint: str, channels=tuple(SENSORS), batch_id: str = "stream"
) -> StreamingQuery:
    """Append every new message to ``target`` in long form, malformed ones to ``target/quarantine``.

    A micro-batch owns the folder named after it and replaces it when it is run
    again, so a lost executor or driver leaves every message in the log once.
    """
    def append(batch: DataFrame, number: int) -> None:
        feed = F.coalesce(F.array_position(F.array(*[F.lit(f) for f in FEEDS]), F.col("source")), F.lit(0))
        rows = batch.select(
            *[F.col(c) for c in message_schema(channels).names],
            feed.cast("int").alias("priority"),
            F.lit(number).cast("long").alias("batch"),
            F.col("_metadata.file_modification_time").alias("arrived_at"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("split_at"),
            F.monotonically_increasing_id().alias("line"),
        )
        rows = rows.persist()  # the JSON is parsed once
        bad = rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, "path", "line")
        bad.write.mode("overwrite").parquet(f"{target}/quarantine/batch_no={number}")
        good = message_frame(rows, channels)
        long = wide_to_long(good, batch_id, channels, keep=ARRIVAL)
        long.write.mode("overwrite").parquet(f"{target}/readings/batch_no={number}")
        rows.unpersist()

    return (
        messages.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def current_readings(spark: SparkSession, target: str) -> DataFrame:
    """The log with one row per sensor and instant: the last feed, the last arrival."""
    log = spark.read.parquet(f"{target}/readings")
    return dedup_keep_last(log, order=ARRIVAL)


def quarantined(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/quarantine")


def stream_dedup(readings: DataFrame, delay: str = "10 minutes", keys=KEYS) -> DataFrame:
    """First row per key within the watermark; state is dropped as the watermark passes.

    Keeps the first arrival. ``current_readings`` gives the last one exactly.
    """
    return readings.withWatermark(keys[-1], delay).dropDuplicatesWithinWatermark(list(keys))
