"""Dense row numbers in file order, without sorting the rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fumarole.plans.sizing import lookup, stored

INDEX = "row_index"
SPLIT = ["_path", "_at"]


def with_row_index(df: DataFrame, name: str = INDEX) -> DataFrame:
    """Number the rows of a file scan from 0 in file order.

    ``df`` must be a scan (or a projection of one), so that ``_metadata`` is
    there. The rows are stored once with their split and their place in it: how a
    file is split may differ from one job to the next. The counts of the splits
    give each its offset; the table of splits, one row per split of the input, is
    all that is ordered in one place. A row without a number fails the job.
    """
    path, at = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    rows = stored(df.select("*", path.alias("_path"), at.alias("_at"), F.monotonically_increasing_id().alias("_id")), "numbered")
    splits = rows.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    upto = F.sum("_n").over(Window.orderBy(*SPLIT).rowsBetween(Window.unboundedPreceding, 0))
    offsets = splits.select(*SPLIT, (upto - F.col("_n") - F.col("_first")).alias("_shift"))
    lost = F.raise_error(F.lit("a row without an offset")).cast("long")
    return (
        lookup(rows, offsets, SPLIT)
        .withColumn(name, F.coalesce(F.col("_id") + F.col("_shift"), lost))
        .drop(*SPLIT, "_id", "_shift")
    )
