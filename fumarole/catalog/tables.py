"""The driver tables seen as telemetry."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fumarole.settings import SENSORS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor_of(user: str = "user_id") -> Column:
    return F.expr(f"concat('S', lpad(cast(pmod({user}, 16) + 1 as string), 2, '0'))")


def reading_of() -> Column:
    """Event values with missing ones planted: lone rows and runs."""
    return F.expr(
        "case when pmod(event_id, 23) <> 0 and pmod(event_id div 60, 25) <> 0 then cast(value as float) end"
    )


def event_readings(events: DataFrame, grain: str | None = "minute", keep=()) -> DataFrame:
    ts = "ts" if grain is None else f"cast(date_trunc('{grain}', ts) as timestamp_ntz)"
    return events.select(
        sensor_of().alias("sensor_id"), F.expr(ts).alias("timestamp"), reading_of().alias("reading_value"),
        F.col("event_id").alias("seq"), *keep,
    )


def readings(spark: SparkSession, sf_dir: str, grain: str | None = "minute") -> DataFrame:
    return event_readings(table(spark, sf_dir, "events"), grain)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 channels per vector, one vector per minute."""
    channels = [f"cast(element_at(embedding, {4 * k + 1}) as double) as {s}" for k, s in enumerate(SENSORS)]
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", f"{minute_of('vec_id')} as timestamp", "'batch' as source", *channels
    )


def minute_of(index: str) -> str:
    """SQL for the wall-clock minute with this number, counted from 2025."""
    return f"timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, cast({index} as int), 0)"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 64 components as text cells ``position:value``, one column each."""
    columns = [
        f"concat('{k}:', cast(cast(element_at(embedding, {k}) as double) as string)) as f{k:02d}"
        for k in range(1, 65)
    ]
    return table(spark, sf_dir, "embeddings").selectExpr("vec_id", *columns)
