"""Series cut into blocks, so that row windows of one sensor run in many tasks.

``partitionBy(sensor_id)`` gives a sensor to one task however long it is. A
series with more than ``block_rows`` rows is therefore cut in time order into
blocks of about that many rows. The rows next to a cut are copied into the
neighbouring block (the halo), windows run per (sensor, block), and the copies
are dropped afterwards. A window looking ``before`` rows back and ``after`` rows
ahead sees the very rows it would see in the whole series.

Where the cuts lie follows from row counts per time cell. Cells start as equal
slices of a series; a cell that turns out crowded is sliced again, so a burst of
readings does not make a huge block. Cell tables have a proven bound, about
``MAX_BLOCKS * CELLS_PER_BLOCK`` rows, which is why they may pass the driver and
be broadcast.
"""

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fumarole.functions import micros
from fumarole.plans.sizing import is_small
from fumarole.settings import BLOCK_ROWS, CELLS_PER_BLOCK, MAX_BLOCKS, SENSOR, TIME

OWN, BLOCK = "_own", "_block"


def over_series(
    df: DataFrame,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    before: int,
    after: int = 0,
    key: str = SENSOR,
    order: str = TIME,
    block_rows: int | None = None,
) -> DataFrame:
    """Apply ``build(rows, window)`` to every series; frames may reach ``before``/``after`` rows.

    ``block_rows=None`` decides by size: a table small enough for one task keeps
    the plain per-sensor window. A number forces the layout to be computed.
    """
    cells = None
    if block_rows is not None or not is_small(df):
        cells = cell_table(df, before, after, key, order, block_rows or BLOCK_ROWS)
    if cells is None:
        return build(df, Window.partitionBy(key).orderBy(order))
    out = build(cells.copies(df), Window.partitionBy(key, BLOCK).orderBy(order))
    return out.where(F.col(BLOCK) == F.col(OWN)).drop(BLOCK, OWN)


class CellTable:
    """Time cells of the long series with the blocks each cell belongs to."""

    def __init__(self, spark, key: T.StructField, order: T.StructField, levels, cells):
        self.spark, self.key, self.order = spark, key, order
        self.levels, self.cells = levels, cells

    def located(self, df: DataFrame, how: str = "left") -> DataFrame:
        """Add ``_cell``, the start of the row's time cell; null outside long series."""
        key = self.key.name
        schema = T.StructType([
            T.StructField(key, self.key.dataType),
            T.StructField("_cell", T.LongType()),
            T.StructField("_base", T.LongType()),
            T.StructField("_width", T.LongType()),
        ])
        out = df.withColumn("_t", micros(F.col(self.order.name), self.order.dataType))
        out = out.withColumn("_cell", F.lit(-1).cast("long")).withColumn("_slice", F.lit(None).cast("long"))
        for level in self.levels:
            out = out.join(F.broadcast(_local(self.spark, level, schema)), [key, "_cell"], how)
            start = F.col("_base") + F.floor((F.col("_t") - F.col("_base")) / F.col("_width")) * F.col("_width")
            out = (
                out.withColumn("_cell", F.coalesce(start, F.col("_cell")))
                .withColumn("_slice", F.coalesce("_width", "_slice"))
                .drop("_base", "_width")
            )
        return out.drop("_t")

    def copies(self, df: DataFrame) -> DataFrame:
        """Rows with their own block and, for halo rows, the blocks next to it."""
        schema = T.StructType([
            T.StructField(self.key.name, self.key.dataType),
            T.StructField("_cell", T.LongType()),
            T.StructField(OWN, T.LongType()),
            T.StructField("_low", T.LongType()),
            T.StructField("_high", T.LongType()),
        ])
        table = F.broadcast(_local(self.spark, self.cells, schema))
        rows = self.located(df).join(table, [self.key.name, "_cell"], "left")
        zero = F.lit(0).cast("long")
        return (
            rows.withColumn(OWN, F.coalesce(OWN, zero))
            .withColumn(BLOCK, F.explode(F.sequence(F.coalesce("_low", zero), F.coalesce("_high", zero))))
            .drop("_cell", "_slice", "_low", "_high")
        )


def cell_table(
    df: DataFrame, before: int, after: int, key: str, order: str, block_rows: int,
    max_blocks: int = MAX_BLOCKS,
) -> CellTable | None:
    """Measure the series; None when none is longer than ``block_rows``."""
    spark = df.sparkSession
    fields = df.schema[key], df.schema[order]
    narrow = df.select(key, order)
    t = micros(F.col(order), fields[1].dataType)
    # At most rows / block_rows series are long, which bounds what is collected.
    long = (
        narrow.groupBy(key).agg(F.count(order).alias("n"), F.min(t).alias("t0"), F.max(t).alias("t1"))
        .where(F.col("n") > block_rows).toArrow().to_pandas()
    )
    if long.empty:
        return None
    block_rows = max(block_rows, -(-int(long["n"].sum()) // max_blocks))
    per_cell = max(1, block_rows // CELLS_PER_BLOCK)
    burst = 2 * block_rows

    levels, kept = [], []
    crowded = long.assign(_cell=np.int64(-1), _base=long["t0"], _slice=long["t1"] - long["t0"] + 1)
    while not crowded.empty:
        slices = np.ceil(crowded["n"] / per_cell).astype("int64")
        levels.append(crowded[[key, "_cell", "_base"]].assign(_width=-(-crowded["_slice"] // slices)))
        # Inner joins keep just the rows of the cells sliced last.
        counts = (
            CellTable(spark, *fields, levels, None).located(narrow, how="inner")
            .groupBy(key, "_cell", "_slice").agg(F.count(order).alias("n")).toArrow().to_pandas()
        )
        again = (counts["n"] > burst) & (counts["_slice"] > 1)
        kept.append(counts[~again])
        crowded = counts[again].assign(_base=lambda cells: cells["_cell"])
    cells = pd.concat(kept).sort_values([key, "_cell"])
    placed = [_place(g, key, before, after, block_rows) for _, g in cells.groupby(key, sort=False)]
    return CellTable(spark, *fields, levels, pd.concat(placed, ignore_index=True))


def _local(spark, rows: pd.DataFrame, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(pa.Table.from_pandas(rows[schema.names], preserve_index=False), schema)


def _place(cells: pd.DataFrame, key: str, before: int, after: int, block_rows: int) -> pd.DataFrame:
    """Blocks of one series' cells: the own one and the range that needs the cell as halo."""
    first = cells["n"].cumsum().to_numpy() - cells["n"].to_numpy()
    end = first + cells["n"].to_numpy()
    _, starts, own = np.unique(first // block_rows, return_index=True, return_inverse=True)
    block_start = first[starts]
    block_end = np.append(block_start[1:], end[-1])
    return pd.DataFrame({
        key: cells[key].to_numpy(), "_cell": cells["_cell"].to_numpy(), OWN: own.astype("int64"),
        "_low": np.searchsorted(block_end, first - after, side="right").astype("int64"),
        "_high": (np.searchsorted(block_start, end + before, side="left") - 1).astype("int64"),
    })
