"""Row-window features of a stream, one micro-batch at a time with the batch operators.

A micro-batch is joined by the rows carried over from the ones before: the last
rows of every sensor, which new frames reach back to, and rows still waiting.
Series are cut into blocks as in batch, so a sensor that sends most of the rows,
or a long backlog read at once, does not end in one task.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fumarole.operators.clean import fill_short_gaps
from fumarole.operators.windows import feature_columns, rule_columns
from fumarole.plans.blocks import over_series
from fumarole.plans.sizing import lookup
from fumarole.settings import MAX_GAP, SENSOR, THRESHOLD, TIME, VALUE, WINDOW
from fumarole.sinks import versions

CARRIED = [SENSOR, TIME, VALUE, "_done", "_mark"]
STATE = "carried"
#: States that stay: the last one, and the one before it for a batch that is run again.
STATES = 2


def rolling_batches(
    readings: DataFrame, target: str, checkpoint: str, delay_seconds: float = 0, window: int = WINDOW,
    max_gap: int = MAX_GAP, threshold: float = THRESHOLD, block_rows: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the features of every settled reading to ``target``.

    A reading is settled when readings of its sensor that are ``delay_seconds`` younger
    have come and, if it is missing, when its run is known to be short or long. What
    arrives for settled times, or without sensor or instant, goes to ``late_readings``.
    Readings must be unique per sensor and instant. A micro-batch replaces its own
    output, state and work folders when it is run again. ``trigger`` holds the arguments
    of the stream's trigger, by default all that is there.
    """
    past = 2 * (window - 1)
    delay = int(delay_seconds * 1_000_000)
    at = F.unix_micros(F.col(TIME))

    def kept(df: DataFrame, name: str) -> DataFrame:
        """``df`` written to a folder that every micro-batch replaces, and read back."""
        path = f"{checkpoint}/work/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(SENSOR, TIME, F.col(VALUE).cast("double").alias(VALUE), F.lit(False).alias("_done"))
        if number:
            carried = spark.read.parquet(f"{checkpoint}/{STATE}/{number - 1}")
            # Every sensor seen so far has carried rows, and with them its own mark.
            marks = carried.groupBy(SENSOR).agg(F.max("_mark").alias("_mark"))
            rows = lookup(rows, marks, [SENSOR])
        else:
            rows = rows.withColumn("_mark", F.lit(None).cast("long"))
        rows = kept(rows, "arrived")
        late = F.col(SENSOR).isNull() | F.col(TIME).isNull() | F.coalesce(at <= F.col("_mark"), F.lit(False))
        rows.where(late).select(SENSOR, TIME, VALUE).write.mode("overwrite").parquet(f"{checkpoint}/late/batch_no={number}")
        rows = rows.where(~late).select(*CARRIED)
        if number:
            rows = rows.unionByName(carried)
        rows = kept(rows, "batch")
        upto = rows.groupBy(SENSOR).agg(F.greatest(F.max(at) - delay, F.max("_mark")).alias("_upto"))
        marked = lookup(rows.drop("_mark"), upto, [SENSOR])

        settled = marked.where(at <= F.col("_upto")).drop("_upto")
        done = kept(_settled(settled, window, max_gap, threshold, block_rows), "settled")
        out = done.where(~F.col("_done") & ~F.col("_open")).drop("_done", "_open", "_raw")
        out.write.mode("overwrite").parquet(f"{target}/batch_no={number}")

        last = F.row_number().over(Window.partitionBy(SENSOR).orderBy(F.desc(TIME)))
        tail = done.where(~F.col("_open")).select(SENSOR, TIME, VALUE).withColumn("_n", last).where(F.col("_n") <= past)
        waiting = marked.where(at > F.col("_upto")).drop("_upto").unionByName(
            done.where("_open").select(SENSOR, TIME, F.col("_raw").alias(VALUE), "_done"))
        carry = tail.drop("_n").withColumn("_done", F.lit(True)).unionByName(waiting)
        carry = lookup(carry, upto, [SENSOR]).withColumnRenamed("_upto", "_mark")
        carry.select(*CARRIED).write.mode("overwrite").parquet(f"{checkpoint}/{STATE}/{number}")
        for old in _states(spark, checkpoint)[:-STATES]:
            versions.remove(spark, f"{checkpoint}/{STATE}/{old}")

    return (
        readings.writeStream.foreachBatch(step).option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def _settled(rows: DataFrame, window: int, max_gap: int, threshold: float, block_rows: int | None) -> DataFrame:
    """Features and flags of ``rows`` (with _done), and _open where a short run may still grow."""
    def build(part, w):
        known = F.col(VALUE)
        if max_gap:
            # Short runs that reach the last row so far may still grow.
            ahead = w.rowsBetween(1, max_gap)
            rest = F.count(F.lit(1)).over(ahead) - F.count(VALUE).over(ahead)
            part = part.withColumns({"_rest": rest, "_raw": known, "_ahead": F.count(F.lit(1)).over(ahead)})
            part = fill_short_gaps(part, w, max_gap)
            part = part.withColumn(VALUE, F.when(F.col("_done"), F.col("_raw")).otherwise(F.col(VALUE)))
            growing = ~F.col("_done") & (F.col("is_imputed") == 1) & (F.col("_rest") == F.col("_ahead"))
            part = part.withColumn("_open", growing).drop("_rest", "_ahead")
        else:
            part = part.withColumns({"is_imputed": F.lit(0), "_open": F.lit(False), "_raw": known})
        return feature_columns(part, w, window)

    done = over_series(rows, build, before=2 * (window - 1) + max_gap, after=max_gap, block_rows=block_rows)
    return rule_columns(done, threshold)


def _states(spark: SparkSession, checkpoint: str) -> list[int]:
    return sorted(int(name) for name in versions.names(spark, f"{checkpoint}/{STATE}") if name.isdigit())


def flush_rolling(
    spark: SparkSession, target: str, checkpoint: str, window: int = WINDOW, max_gap: int = MAX_GAP,
    threshold: float = THRESHOLD, silent_seconds: float | None = None, block_rows: int | None = None,
) -> None:
    """Emit what ``rolling_batches`` still holds back, as if the series ended there.

    To be called while the stream stands still, with the arguments it had. With ``silent_seconds``
    only sensors that are that much older than the newest one of all are taken to have ended. The rows
    are provisional: they take the place of the next micro-batch, whose run emits them again with what
    has come, and replaces them.
    """
    found = _states(spark, checkpoint)
    if not found:
        return
    rows = spark.read.parquet(f"{checkpoint}/{STATE}/{found[-1]}").drop("_mark")
    if silent_seconds is not None:
        newest = rows.groupBy(SENSOR).agg(F.max(F.unix_micros(F.col(TIME))).alias("_newest"))
        last = newest.agg(F.max("_newest")).first()[0]
        ended = F.col("_newest") < (last or 0) - int(silent_seconds * 1_000_000)
        rows = lookup(rows, newest, [SENSOR]).where(ended).drop("_newest")
    done = _settled(rows, window, max_gap, threshold, block_rows)
    done.where(~F.col("_done")).drop("_done", "_open", "_raw").write.mode("overwrite").parquet(f"{target}/batch_no={found[-1] + 1}")


def late_readings(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What ``rolling_batches`` could not place any more, by ``batch_no``."""
    return spark.read.parquet(f"{checkpoint}/late")
