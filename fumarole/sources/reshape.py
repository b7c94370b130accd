"""From wide records to long readings."""

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fumarole.functions import finite, indexed_value
from fumarole.plans.rowindex import INDEX, with_row_index
from fumarole.settings import (
    FIRST_INSTANT, GAS_TYPE, N_CHANNELS, SENSORS, TARGET_NAMES, UNIT,
)

#: Rows in which a column is first looked for a number.
FIRST_ROWS = 1000


def feature_columns(df: DataFrame, targets=TARGET_NAMES) -> list[str]:
    return [c for c in df.columns if c.lower() not in targets]


def usable_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: how many of its cells hold a number; one pass for all.

    Cells become rows, so one expression parses them whatever the number of
    columns; the counts are summed before anything is shuffled.
    """
    texts = [F.expr(f"cast(`{c}` as string) as `{c}`") for c in columns]
    cells = df.select(*texts).unpivot([], [F.col(f"`{c}`") for c in columns], "column_name", "cell")
    return cells.groupBy("column_name").agg(F.count(indexed_value(F.col("cell"))).alias("n_usable"))


def usable_names(df: DataFrame, columns: list[str], first_rows: int = FIRST_ROWS) -> set[str]:
    """Columns with a number in any cell: most show one in the first rows, only the others are read whole."""
    def found(rows: DataFrame, of: list[str]) -> set[str]:
        return {r["column_name"] for r in usable_counts(rows, of).where("n_usable > 0").collect()}

    seen = found(df.select(*(F.col(f"`{c}`") for c in columns)).limit(first_rows), columns) if columns else set()
    rest = [c for c in columns if c not in seen]
    return seen | found(df, rest) if rest else seen


def channel_starts(n: int, channels: int = N_CHANNELS) -> list[int]:
    """First column of each channel when ``n`` columns are dealt into even blocks."""
    size, extra = divmod(n, channels)
    return [k * size + min(k, extra) for k in range(channels)]


def pick_channels(df: DataFrame, columns: list[str], names=tuple(SENSORS)) -> dict[str, Column]:
    """The first usable column of every channel block as a finite number."""
    usable = usable_names(df, columns)
    kept = [c for c in columns if c in usable]
    if len(kept) < len(names):
        raise ValueError(f"{len(kept)} usable numeric columns, at least {len(names)} are needed")
    starts = channel_starts(len(kept), len(names))
    return {name: finite(indexed_value(F.col(f"`{kept[s]}`"))) for name, s in zip(names, starts)}


def with_instants(
    df: DataFrame, index: str = INDEX, start: str = FIRST_INSTANT, step_seconds: int = 60
) -> DataFrame:
    """Instants in equal steps from ``start`` (UTC) by row number."""
    first = datetime.fromisoformat(start).replace(tzinfo=timezone.utc)
    seconds = F.lit(int(first.timestamp())) + F.col(index) * step_seconds
    return df.withColumn("timestamp", F.timestamp_seconds(seconds))


def canonicalize(
    df: DataFrame, names=tuple(SENSORS), targets=TARGET_NAMES, start: str = FIRST_INSTANT,
    step_seconds: int = 60,
) -> DataFrame:
    """A wide file scan as one finite column per channel, with instants by row position."""
    channels = pick_channels(df, feature_columns(df, targets), names)
    rows = with_instants(with_row_index(df), INDEX, start, step_seconds)
    return rows.select("timestamp", F.lit("batch").alias("source"), *[c.alias(n) for n, c in channels.items()])


def wide_to_long(
    wide: DataFrame, batch_id: str, channels=tuple(SENSORS), gas_type: str = GAS_TYPE, unit: str = UNIT,
    keep=(),
) -> DataFrame:
    """One row per instant and channel; missing readings are kept, columns not in ``keep`` dropped."""
    ids = ["timestamp", "source", *keep]
    numbers = [F.nanvl(F.col(c).try_cast("float"), F.lit(None).cast("float")).alias(c) for c in channels]
    long = wide.select(*ids, *numbers).unpivot(ids, list(channels), "sensor_id", "reading_value")
    return long.select(
        "sensor_id", "timestamp", "reading_value", F.lit(gas_type).alias("gas_type"),
        F.lit(unit).alias("unit"), "source", F.current_timestamp().alias("ingestion_timestamp"),
        F.lit(batch_id).alias("load_batch_id"), *keep,
    )


def union_sources(sources: list[tuple[DataFrame, int]]) -> DataFrame:
    """All rows of all sources, each marked with the priority of its source."""
    out = None
    for df, priority in sources:
        part = df.withColumn("priority", F.lit(priority))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def positional_join(left: DataFrame, right: DataFrame, index: str = INDEX) -> DataFrame:
    """Columns of two file scans side by side, row by row; the shorter one ends in nulls."""
    return with_row_index(left, index).join(with_row_index(right, index), index, "full")
