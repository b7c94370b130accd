"""File sources: wide CSV, JSON messages, Parquet, quality reports."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fumarole.functions import null_if_nan, parse_instant
from fumarole.plans.rowindex import with_row_index
from fumarole.schema import CORRUPT, message_schema
from fumarole.settings import SENSORS


def read_wide_csv(spark: SparkSession, path) -> DataFrame:
    """Wide records with a header; cells stay text, as they may read ``index:value``."""
    return spark.read.option("header", True).csv(path)


def read_messages(
    spark: SparkSession, paths, channels=tuple(SENSORS), on_bad: str = "quarantine", number: str | None = None
) -> DataFrame:
    """JSON-lines messages of all ``paths`` that exist; none of them gives an empty frame.

    Blank lines are skipped. A malformed line is kept in ``_corrupt_record``, or
    fails the read with ``on_bad="fail"``. ``number`` names a column for the place
    of a message within its path.
    """
    if on_bad not in ("quarantine", "fail"):
        raise ValueError(f"on_bad must be 'quarantine' or 'fail', not {on_bad!r}")
    schema = message_schema(channels, corrupt=on_bad == "quarantine")
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE" if on_bad == "quarantine" else "FAILFAST")
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        try:
            messages = reader.json(path)
            found.append(with_row_index(messages, number) if number else messages)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    if not found:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(number, F.lit(None).cast("long")) if number else empty
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def message_frame(messages: DataFrame, channels=tuple(SENSORS)) -> DataFrame:
    """Parsed messages: instant and numeric channels, null where the text is neither."""
    rows = messages
    if CORRUPT in rows.columns:
        # Null just when the line is whole; a second column, as Spark refuses plans that
        # read nothing but the corrupt record.
        mark = F.concat(F.col(CORRUPT), F.coalesce(F.col("timestamp").cast("string"), F.lit("")))
        rows = rows.where(mark.isNull()).drop(CORRUPT)
    numbers = {c: null_if_nan(F.col(c).try_cast("double")) for c in channels if c in rows.columns}
    return rows.withColumns({"timestamp": parse_instant(F.col("timestamp")), **numbers})


def read_parquet_any(spark: SparkSession, path, nanos_cols=()) -> DataFrame:
    """Parquet, also with nanosecond instants, which come out in microseconds."""
    if nanos_cols:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = spark.read.parquet(path)
    return df.withColumns({
        c: F.timestamp_micros(F.expr(f"(`{c}` - pmod(`{c}`, 1000)) div 1000")) for c in nanos_cols
    })


def read_report(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)
