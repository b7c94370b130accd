"""Summaries for display: totals, one sensor's tail, latest alerts, duplicates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumarole.settings import KEYS, RECENT_ALERTS, SENSOR, TAIL_ROWS, TIME, VALUE


def kpi_summary(df: DataFrame, flag: str = "ml_anomaly") -> DataFrame:
    """Readings, sensors, flagged readings, their share and the missing share, in one row."""
    missing = F.col(VALUE).isNull().cast("int")
    sensors = df.groupBy(SENSOR).agg(
        F.count("*").alias("n"), F.sum(flag).alias("f"), F.count(flag).alias("known"),
        F.sum(missing).alias("m"),
    )
    total = sensors.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("readings"), F.count(SENSOR).alias("sensors"),
        F.coalesce(F.sum("f"), F.lit(0)).cast("long").alias("anomalies"),
        F.sum("known").alias("known"), F.sum("m").alias("m"),
    )
    return total.select(
        "readings", "sensors", "anomalies",
        (F.col("anomalies") / F.nullif(F.col("known"), F.lit(0))).alias("anomaly_rate"),
        (F.col("m") / F.nullif(F.col("readings"), F.lit(0))).alias("missing_rate"),
    )


def sensor_tail(df: DataFrame, sensor: str = "S01", n: int = TAIL_ROWS) -> DataFrame:
    """Last ``n`` rows of one sensor in time order."""
    last = df.where(F.col(SENSOR) == sensor).orderBy(F.desc(TIME)).limit(n)
    return last.orderBy(TIME)


def recent_alerts(df: DataFrame, n: int = RECENT_ALERTS) -> DataFrame:
    return df.orderBy(F.desc(TIME), SENSOR).limit(n)


def distinct_sensors(df: DataFrame) -> DataFrame:
    return df.select(SENSOR).distinct().orderBy(SENSOR)


def duplicate_keys(df: DataFrame, keys=KEYS) -> DataFrame:
    """Rows after the first of their key, counted."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def sort_readings(df: DataFrame, by=KEYS) -> DataFrame:
    """Global order, nulls last; a range-partitioned sort, so no key overloads a task."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in by])
