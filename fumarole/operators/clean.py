"""Cleaning: deterministic dedup, short-gap fill, rolling outliers, min-max scaling."""

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fumarole.functions import as_flag
from fumarole.operators.windows import frame, rolling_columns, z_of
from fumarole.plans.blocks import BLOCK, OWN, over_series
from fumarole.plans.sizing import lookup
from fumarole.settings import KEYS, MAX_GAP, MIN_CLEAN, SENSOR, THRESHOLD, TIME, VALUE, WINDOW


def drop_null_keys(df: DataFrame) -> DataFrame:
    return df.dropna(subset=list(KEYS))


def dedup_keep_last(df: DataFrame, keys=KEYS, order=("priority", "seq")) -> DataFrame:
    """One row per key: the last by ``order``, even when its reading is null.

    An aggregate rather than a ranking window, so copies of a key collapse
    before the shuffle and a key with very many copies is no hot group.
    """
    rows = df.dropna(subset=list(keys))
    rest = [c for c in df.columns if c not in keys]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    flat = all(isinstance(kinds[c], (T.NumericType, T.BooleanType, T.DatetimeType)) for c in rest)
    if flat and len(order) == 1 and isinstance(kinds[order[0]], T.IntegralType):
        # Fixed-width buffers, so Spark aggregates by hash and need not sort.
        rank = F.coalesce(F.col(order[0]).cast("long"), F.lit(-(2**63)))
        kept = [F.max_by(c, rank).alias(c) for c in rest]
        return rows.groupBy(*keys).agg(*kept).select(*df.columns)
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    out = rows.groupBy(*keys).agg(last).select(*keys, "_last.*")
    return out.select(*df.columns)


def fill_short_gaps(rows: DataFrame, w: WindowSpec, max_gap: int, value: str = VALUE) -> DataFrame:
    """Fill short missing runs, looking ``max_gap`` rows both ways.

    A row outside the series is not missing, so runs at either end count as the
    runs they are. With ``max_gap`` neighbours on each side a run of at most
    ``max_gap`` rows is seen whole and a longer one is seen to be longer.
    """
    missing, steps = F.col(value).isNull().cast("int"), range(1, max_gap + 1)
    sides = {"back": F.lag, "ahead": F.lead}
    near = {f"_{side}{k}": shift(missing, k, 0).over(w) for side, shift in sides.items() for k in steps}
    near["_previous"] = F.last(value, ignorenulls=True).over(w.rowsBetween(-max_gap, -1))
    rows = rows.withColumns(near)
    # Missing neighbours in an unbroken chain: 1 + 1*1 + 1*1*1 ...
    chains = [" * ".join(f"_{side}{j}" for j in range(1, k + 1)) for side in sides for k in steps]
    run = " + ".join(["1", *chains])
    short = F.expr(f"{value} is null and {run} <= {max_gap}")
    rows = rows.withColumn("is_imputed", as_flag(short))
    fill = F.when(F.col("is_imputed") == 1, F.col("_previous")).otherwise(F.col(value))
    return rows.withColumn(value, fill).drop(*near)


def gap_fill_short(df: DataFrame, max_gap: int = MAX_GAP, block_rows: int | None = None) -> DataFrame:
    """Fill runs of at most ``max_gap`` missing readings with the last reading before them.

    Longer runs stay as they are. A short run at the start of a series has
    nothing before it: it stays null but is flagged.
    """
    def build(rows, w):
        return fill_short_gaps(rows, w, max_gap)

    return over_series(df, build, before=max_gap, after=max_gap, block_rows=block_rows)


def clean_windows(
    df: DataFrame, max_gap: int = MAX_GAP, window: int = WINDOW, min_rows: int = MIN_CLEAN,
    threshold: float = THRESHOLD, block_rows: int | None = None,
) -> DataFrame:
    """Gap fill, rolling statistics and outlier flag in one pass over each series."""
    def build(rows, w):
        stats = rolling_columns(frame(w, window), min_mean=min_rows, min_std=min_rows)
        rows = fill_short_gaps(rows, w, max_gap).withColumns(
            {"rolling_avg": stats["rolling_avg"], "moving_std": stats["moving_std"]}
        )
        return rows.withColumn("outlier_flag", as_flag(F.abs(z_of()) > threshold))

    return over_series(df, build, before=window - 1 + max_gap, after=max_gap, block_rows=block_rows)


def minmax_normalize(
    df: DataFrame, value: str = VALUE, out: str = "reading_normalized", extremes_of: DataFrame | None = None
) -> DataFrame:
    """Scale every sensor to [0, 1]; 0 for all rows of a constant or empty sensor.

    ``extremes_of`` may name rows with the same extremes that cost less to
    compute: gap filling repeats readings, so the rows before it will do.
    """
    x = F.col(value).cast("double")
    stats = (df if extremes_of is None else extremes_of).groupBy(SENSOR).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    spread = F.col("_hi") - F.col("_lo")
    scaled = F.when(spread != 0, (x - F.col("_lo")) / F.nullif(spread, F.lit(0.0))).otherwise(F.lit(0.0))
    return lookup(df, stats, [SENSOR]).withColumn(out, scaled).drop("_lo", "_hi")


def missing_runs(df: DataFrame, value: str = VALUE, block_rows: int | None = None) -> DataFrame:
    """Number the runs of present/missing readings of a series and size the missing ones.

    Run numbers count from 1 over the whole series, and a run may be as long as
    the series. Both are built from per-block parts: starts are counted inside a
    block and shifted by the starts of the blocks before; run sizes are summed
    per block first.
    """
    def mark(rows, w):
        missing = F.col(value).isNull().cast("int")
        starts = F.coalesce((missing != F.lag(missing).over(w)).cast("int"), F.lit(1))
        rows = rows.withColumns({"is_missing": missing, "_start": starts})
        if BLOCK in rows.columns:
            return rows.withColumn("_part", F.col(OWN))
        rows = rows.withColumn("run_id", F.sum("_start").over(w).cast("long")).drop("_start")
        sizes = F.sum("is_missing").over(Window.partitionBy(SENSOR, "run_id"))
        return rows.withColumn("gap_size", sizes.cast("long"))

    marked = over_series(df, mark, before=1, block_rows=block_rows)
    if "_part" not in marked.columns:
        return marked
    # Two columns name a series, so that rows without a sensor meet in joins as well.
    series = ["_name", "_none"]
    names = {"_name": F.coalesce(F.col(SENSOR).cast("string"), F.lit("")), "_none": F.col(SENSOR).isNull()}
    part = [*series, "_part"]
    marked = marked.withColumns(names)
    marked = marked.withColumn("_runs", F.sum("_start").over(Window.partitionBy(*part).orderBy(TIME)))
    totals = marked.groupBy(*part).agg(F.sum("_start").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*series).orderBy("_part"))
    offsets = totals.select(*part, (upto - F.col("_n")).alias("_before"))
    numbered = (
        lookup(marked, offsets, part)
        .withColumn("run_id", (F.col("_runs") + F.col("_before")).cast("long"))
        .drop("_start", "_runs", "_before")
    )
    sizes = numbered.groupBy(*series, "run_id", "_part").agg(F.sum("is_missing").alias("_n"))
    whole = F.sum("_n").over(Window.partitionBy(*series, "run_id"))
    sizes = sizes.withColumn("gap_size", whole.cast("long")).drop("_n")
    return numbered.join(sizes, [*series, "run_id", "_part"]).drop(*series, "_part").select(*df.columns, "is_missing", "run_id", "gap_size")
