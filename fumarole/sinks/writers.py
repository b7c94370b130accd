"""Tables, partitioned Parquet, CSV, JSON reports, model nodes."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fumarole.schema import NODES, SINK_TYPES


def as_stored(df: DataFrame) -> DataFrame:
    """Narrow types for storage: float readings, one-byte flags."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in SINK_TYPES.items() if c in df.columns})


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str = "reading_date", mode: str = "overwrite") -> None:
    """Parquet by date; ``mode="dynamic"`` replaces only the dates that ``df`` has.

    Rows are gathered by date so that a date has few files, while a date holding
    much of the data is split over tasks and files.
    """
    if mode not in ("overwrite", "dynamic"):
        raise ValueError(f"mode must be 'overwrite' or 'dynamic', not {mode!r}")
    writer = df.hint("rebalance", by).write.mode("overwrite").partitionBy(by)
    writer.option("partitionOverwriteMode", "dynamic" if mode == "dynamic" else "static").parquet(path)


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_model(nodes: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NODES).parquet(path)
