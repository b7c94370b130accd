"""One query per operator: (spark, folder of the tables) -> DataFrame."""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fumarole.catalog.tables import (
    cells, event_readings, minute_of, readings, sensor_of, table, vectors,
)
from fumarole.functions import indexed_value, parse_instant
from fumarole.operators import clean, cross, model, quality, quantiles, similarity, summary, windows
from fumarole.operators.quantile_states import QuantileStates
from fumarole.plans import stages
from fumarole.plans.rowindex import with_row_index
from fumarole.plans.sizing import shared_dir, stored, stored_if_large
from fumarole.settings import CONTAMINATION, SENSORS, SUMMARY_FEATURES
from fumarole.sinks import write_partitioned
from fumarole.sources import (
    feature_columns, pick_channels, positional_join, union_sources, usable_counts, wide_to_long,
)
from fumarole.streaming import (
    current_readings, flush_rolling, ingest_messages, message_stream, rolling_batches, score_batches,
    stream_alerts, stream_dedup, update_statistics, upsert_batches, upserted,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEY = ["sensor_id", "timestamp"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def r6(c: str | Column, name: str | None = None) -> Column:
    if isinstance(c, str):
        return F.expr(f"round(cast({c} as double), 6) as {name or c}")
    return F.round(c.cast("double"), 6).alias(name)


def deduped(spark, sf, grain="minute") -> DataFrame:
    return stored_if_large(clean.dedup_keep_last(readings(spark, sf, grain), order=("seq",)), "unique")


def filled(spark, sf) -> DataFrame:
    return stored_if_large(clean.gap_fill_short(deduped(spark, sf)), "filled")


def scaled(spark, sf) -> DataFrame:
    """Hourly cells, where the sensors share instants."""
    return clean.minmax_normalize(deduped(spark, sf, "hour"))


def clean_rows(spark, sf) -> DataFrame:
    return stages.cleaned(readings(spark, sf), order=("seq",))


def feature_rows(spark, sf) -> DataFrame:
    return stages.features(stored(clean_rows(spark, sf), "cleaned"))


def scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Sources and reshaping

@query
def scan_parquet(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")


@query
def json_extract(spark, sf):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf, "events").select("event_id", k.alias("k"), F.to_json(F.struct(k.alias("k"))).alias("again"))


def feeds(spark, sf) -> list[tuple[DataFrame, int]]:
    """Events as feeds by type; the last feed has all other events too, those without a type as well."""
    events = table(spark, sf, "events").withColumn("source", F.col("event_type"))
    first = ["signup", "click", "error", "purchase"]
    rest = ~F.coalesce(F.col("event_type").isin(first), F.lit(False))
    return [*((events.where(F.col("event_type") == t), p) for p, t in enumerate(first)), (events.where(rest), len(first))]


@query
def union_of_feeds(spark, sf):
    rows = union_sources(feeds(spark, sf))
    return rows.select("event_id", sensor_of().alias("sensor_id"), "source", "priority")


@query
def union_sources_last_feed_wins(spark, sf):
    rows = clean.dedup_keep_last(union_sources([(event_readings(df, keep=["source"]), p) for df, p in feeds(spark, sf)]))
    return rows.select(*KEY, r6("reading_value"), "source", "priority", "seq")


@query
def parse_indexed_value(spark, sf):
    text = F.concat_ws(":", F.col("event_id").cast("string"), F.col("value").cast("string"))
    forms = F.when(F.pmod("event_id", F.lit(5)) == 0, F.concat(F.lit("  "), text, F.lit(" "))) \
        .when(F.pmod("event_id", F.lit(5)) == 1, F.col("value").cast("string")) \
        .when(F.pmod("event_id", F.lit(5)) == 2, F.col("event_type")) \
        .when(F.pmod("event_id", F.lit(5)) == 3, F.concat(F.lit("1:"), text)) \
        .otherwise(F.concat(text, F.lit("e1")))
    return table(spark, sf, "events").select("event_id", r6(indexed_value(forms), "number"))


@query
def usable_columns(spark, sf):
    wide = cells(spark, sf)
    return usable_counts(wide, feature_columns(wide, ("vec_id",)))


@query
def channel_select(spark, sf):
    wide = cells(spark, sf)
    picked = pick_channels(wide, feature_columns(wide, ("vec_id",)))
    return wide.select("vec_id", *[r6(c, name) for name, c in picked.items()])


@query
def assign_timestamps(spark, sf):
    rows = with_row_index(table(spark, sf, "embeddings").select("vec_id"))
    return rows.selectExpr("vec_id", f"{minute_of('row_index')} as timestamp")


@query
def wide_to_long_readings(spark, sf):
    long = wide_to_long(vectors(spark, sf), "batch_1")
    return long.select(*KEY, r6("reading_value"), "gas_type", "unit", "source", "load_batch_id")


@query
def positional_join_columns(spark, sf):
    e = table(spark, sf, "embeddings")
    joined = positional_join(e.select("vec_id", "label"), e.select(F.element_at("embedding", 1).alias("first")))
    return joined.select("row_index", "vec_id", "label", r6("first"))


@query
def parse_timestamp(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    forms = F.when(F.pmod("event_id", F.lit(4)) == 0, F.concat(iso, F.lit("Z"))) \
        .when(F.pmod("event_id", F.lit(4)) == 1, F.concat(iso, F.lit("+00:00"))) \
        .when(F.pmod("event_id", F.lit(4)) == 2, F.concat(iso, F.lit("+05:30"))) \
        .otherwise(F.col("event_type"))
    return table(spark, sf, "events").select("event_id", F.unix_micros(parse_instant(forms)).alias("instant_us"))


@query
def partitioned_write_roundtrip(spark, sf):
    path = scratch(spark, "partitioned")
    write_partitioned(windows.with_reading_date(deduped(spark, sf)), path)
    back = spark.read.parquet(path)
    x = F.col("reading_value").cast("double")
    return back.groupBy(F.col("reading_date").cast("string").alias("reading_date")).agg(
        F.count("*").alias("n_rows"), F.countDistinct("sensor_id").alias("n_sensors"),
        r6(F.sum(x), "total"),
    )


# Cleaning

@query
def drop_null_keys(spark, sf):
    events = table(spark, sf, "events")
    keyed = events.select(
        F.when(F.col("event_type") != "error", sensor_of()).alias("sensor_id"),
        F.when(F.col("event_type") != "signup", F.col("ts")).alias("timestamp"),
        F.col("event_id").alias("seq"),
    )
    return clean.drop_null_keys(keyed)


@query
def dedup_keep_last(spark, sf):
    return deduped(spark, sf).select(*KEY, r6("reading_value"), "seq")


@query
def gap_fill_short(spark, sf):
    return clean.gap_fill_short(deduped(spark, sf)).select(*KEY, r6("reading_value"), "is_imputed")


@query
def missing_runs(spark, sf):
    rows = clean.missing_runs(deduped(spark, sf))
    return rows.select(*KEY, "is_missing", "run_id", "gap_size")


@query
def minmax_normalize(spark, sf):
    return clean.minmax_normalize(filled(spark, sf)).select(*KEY, r6("reading_normalized"))


@query
def rolling_min5(spark, sf):
    rows = clean.clean_windows(deduped(spark, sf))
    return rows.select(*KEY, r6("rolling_avg"), r6("moving_std"))


@query
def outlier_flag(spark, sf):
    return clean.clean_windows(deduped(spark, sf)).select(*KEY, "outlier_flag")


@query
def cleaned_table(spark, sf):
    rows = clean_rows(spark, sf)
    return rows.select(
        *KEY, *[r6(c) for c in ("reading_value", "rolling_avg", "moving_std", "reading_normalized")],
        "is_imputed", "outlier_flag", "reading_date",
    )


# Window features

@query
def rolling_stats(spark, sf):
    rows = windows.rolling_stats(filled(spark, sf))
    return rows.select(*KEY, *[r6(c) for c in ("rolling_avg", "moving_std", "rolling_min", "rolling_max")])


@query
def lags_roc(spark, sf):
    return windows.lags_roc(filled(spark, sf)).select(*KEY, *[r6(c) for c in ("lag_1", "lag_5", "rate_of_change")])


@query
def z_score(spark, sf):
    return windows.z_score(windows.rolling_stats(filled(spark, sf))).select(*KEY, r6("z_score"))


@query
def peak_frequency(spark, sf):
    return windows.peak_frequency(filled(spark, sf)).select(*KEY, "peak_frequency")


@query
def stability_score(spark, sf):
    rows = windows.stability_score(windows.rolling_stats(filled(spark, sf)))
    return rows.select(*KEY, r6("stability_score"))


@query
def anomaly_flag(spark, sf):
    rows = windows.flag_anomalies(windows.z_score(windows.rolling_stats(filled(spark, sf))))
    return rows.select(*KEY, "anomaly_flag")


@query
def time_features(spark, sf):
    rows = windows.time_features(deduped(spark, sf))
    return rows.select(*KEY, "hour_of_day", "is_weekend", "reading_date")


@query
def sliding_window_aggregates(spark, sf):
    rows = windows.sliding_window_aggregates(filled(spark, sf))
    return rows.select(*KEY, *[r6(f"spark_{c}") for c in (
        "rolling_avg", "moving_std", "max", "min", "rate_of_change")])


WINDOW_COLUMNS = [
    "rolling_avg", "moving_std", "rolling_min", "rolling_max", "lag_1", "lag_5", "rate_of_change",
    "z_score", "stability_score",
]


@query
def rule_anomalies(spark, sf):
    """Every reading with its window features and rule flag."""
    rows = windows.window_features(filled(spark, sf))
    return rows.select(
        *KEY, r6("reading_value"), *[r6(c) for c in WINDOW_COLUMNS], "is_imputed", "hour_of_day",
        "is_weekend", "peak_frequency", "anomaly_flag",
    )


@query
def feature_table(spark, sf):
    rows = feature_rows(spark, sf)
    return rows.select(
        *KEY, r6("reading_value"), r6("reading_normalized"), *[r6(c) for c in WINDOW_COLUMNS],
        r6("sensor_correlation"), r6("gas_concentration_est"), "is_imputed", "outlier_flag",
        "hour_of_day", "is_weekend", "peak_frequency", "anomaly_flag", "reading_date",
    )


# Across sensors

@query
def sensor_correlation(spark, sf):
    return cross.sensor_correlation(scaled(spark, sf)).select("timestamp", r6("sensor_correlation"))


@query
def gas_estimate(spark, sf):
    return cross.gas_estimate(scaled(spark, sf)).select("timestamp", r6("gas_concentration_est"))


@query
def correlation_matrix(spark, sf):
    return cross.correlation_matrix(readings(spark, sf, "hour").transform(cross.cell_means, "reading_value")) \
        .select("sensor_a", "sensor_b", r6("correlation"))


@query
def instant_similarity(spark, sf):
    """Hourly cells at every scale; with gaps, hardly two instants share a mask."""
    cells = cross.cell_means(scaled(spark, sf), "reading_normalized")
    return similarity.instant_similarity(cells).select("timestamp", r6("instant_similarity"))


@query
def pivot_mean(spark, sf):
    wide = cross.pivot_mean(readings(spark, sf, "hour"), SENSORS)
    return wide.select("timestamp", *[r6(s) for s in SENSORS])


# Model and alerts

@query
def model_matrix(spark, sf):
    rows = model.model_matrix(feature_rows(spark, sf))
    return rows.select(*KEY, *[r6(c) for c in rows.columns if c not in KEY])


@query
def iforest_model(spark, sf):
    return model.fit_iforest(stored(feature_rows(spark, sf), "features"))


@query
def iforest_score(spark, sf):
    rows = stored(feature_rows(spark, sf), "features")
    scored = stored(model.score_iforest(rows, model.fit_iforest(rows)), "scored")
    return model.flag_top(scored).select(*KEY, "anomaly_score", "ml_anomaly")


@query
def contamination_threshold(spark, sf):
    rows = windows.z_score(windows.rolling_stats(filled(spark, sf)))
    rows = stored(rows.select(*KEY, F.abs("z_score").alias("score")), "scores")
    return model.flag_top(rows, "score").select(*KEY, r6("score"), "ml_anomaly")


@query
def contamination_threshold_by_day(spark, sf):
    """The same flags from states per day, of days that came in four deliveries."""
    rows = windows.z_score(windows.rolling_stats(filled(spark, sf)))
    day = F.date_format("timestamp", "yyyy-MM-dd")
    rows = stored(rows.select(*KEY, F.abs("z_score").alias("score"), day.alias("reading_date")), "scores")
    states = QuantileStates(spark, scratch(spark, "states"), ["score"], [1 - CONTAMINATION])
    for part in range(4):
        states.add(rows.where(F.floor((F.dayofmonth("timestamp") - 1) / 8) == part))
        cut = states.quantiles(lambda upto=part: rows.where(F.floor((F.dayofmonth("timestamp") - 1) / 8) <= upto))["score"][0]
    return model.flag_above(rows, cut, "score").select(*KEY, r6("score"), "ml_anomaly")


def flagged(spark, sf) -> DataFrame:
    return windows.window_features(filled(spark, sf))


@query
def alerts(spark, sf):
    columns = ["timestamp", "sensor_id", "reading_value", "z_score"]
    rows = model.alerts(flagged(spark, sf), "anomaly_flag", columns)
    return rows.select("timestamp", "sensor_id", r6("reading_value"), r6("z_score"), "alert")


def model_flagged(spark, sf) -> DataFrame:
    rows = stored(feature_rows(spark, sf), "features")
    return model.flag_top(stored(model.score_iforest(rows, model.fit_iforest(rows)), "scored"))


@query
def model_alerts(spark, sf):
    """The alert table as it is saved: rows that the forest flags, with their scores."""
    return model.alerts(model_flagged(spark, sf))


@query
def recent_model_alerts_top100(spark, sf):
    return summary.recent_alerts(model.alerts(model_flagged(spark, sf)))


@query
def recent_rule_alerts_top100(spark, sf):
    """The newest of the alerts of every reading on its own, gaps not filled."""
    rows = windows.window_features(readings(spark, sf, None))
    found = model.alerts(rows, "anomaly_flag", ["timestamp", "sensor_id", "reading_value", "z_score"])
    return summary.recent_alerts(found).select("timestamp", "sensor_id", r6("reading_value"), r6("z_score"), "alert")


@query
def recent_alerts_top100(spark, sf):
    events = table(spark, sf, "events").where(F.col("event_type") == "error")
    rows = events.select(sensor_of().alias("sensor_id"), F.col("ts").alias("timestamp"), r6("value"))
    return summary.recent_alerts(rows)


# Quality and summaries

@query
def quality_rules(spark, sf):
    return quality.check(feature_rows(spark, sf))


@query
def quality_consistency(spark, sf):
    rows = readings(spark, sf).withColumns({"reading_normalized": F.lit(0.5), "anomaly_flag": F.lit(0)})
    return quality.report(rows).select(
        "row_count", "sensor_count", "duplicate_sensor_timestamp_rows", "consistency_ok", r6("missing_rate")
    )


@query
def quality_report(spark, sf):
    return quality.report(feature_rows(spark, sf)).select(
        "success", "row_count", "sensor_count", r6("missing_rate"), "duplicate_sensor_timestamp_rows",
        "consistency_ok", F.size(F.filter("expectations", lambda e: ~e["success"])).cast("long").alias("n_failed"),
    )


@query
def kpi_summary(spark, sf):
    rows = summary.kpi_summary(flagged(spark, sf), "anomaly_flag")
    return rows.select("readings", "sensors", "anomalies", r6("anomaly_rate"), r6("missing_rate"))


@query
def duplicate_keys(spark, sf):
    return summary.duplicate_keys(readings(spark, sf))


@query
def feature_describe(spark, sf):
    rows = quantiles.describe(stored(feature_rows(spark, sf), "features"), SUMMARY_FEATURES)
    return rows.select("feature", "count", *[r6(c) for c in quantiles.STATS if c != "count"])


@query
def distinct_sensors(spark, sf):
    return summary.distinct_sensors(readings(spark, sf))


@query
def sensor_tail(spark, sf):
    rows = summary.sensor_tail(flagged(spark, sf), "S01", 1000)
    return rows.select("timestamp", r6("reading_value"), r6("rolling_avg"), "anomaly_flag")


@query
def sort_readings(spark, sf):
    return summary.sort_readings(readings(spark, sf).select(*KEY, r6("reading_value"), "seq"))


# Streams

def drained(spark, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all there is now and read what it appended."""
    path, checkpoint = scratch(spark, name), scratch(spark, f"{name}-checkpoint")
    run = (
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def event_stream(spark, sf, grain) -> DataFrame:
    schema = table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = event_readings(events, grain)
    # Watermarks need instants; ``wall_clock`` turns them back.
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def wall_clock(c: str = "timestamp") -> Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


def landed(spark, rows: DataFrame, part: Column, parts: int, name: str) -> DataFrame:
    """``rows`` as a stream of files, written one after the other by ``part``, one to a micro-batch."""
    path = scratch(spark, name)
    for k in range(parts):
        rows.where(part == k).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def streamed_features(spark, sf) -> DataFrame:
    target = scratch(spark, "rolling")
    readings = event_stream(spark, sf, None)
    run = rolling_batches(readings, target, scratch(spark, "rolling-checkpoint"), max_gap=0)
    run.awaitTermination()
    return spark.read.parquet(target)


@query
def stream_rolling_features(spark, sf):
    return streamed_features(spark, sf).select(
        "sensor_id", wall_clock(), r6("reading_value"), *[r6(c) for c in WINDOW_COLUMNS],
        "peak_frequency", "anomaly_flag")


@query
def stream_alert_feed(spark, sf):
    out = stream_alerts(streamed_features(spark, sf))
    return out.select("sensor_id", wall_clock(), r6("reading_value"), r6("z_score"), "alert")


def batched_features(spark, sf) -> DataFrame:
    """Unique readings of five spans of days, gaps filled as in batch; what waits at the end is flushed."""
    target, checkpoint = scratch(spark, "rolling"), scratch(spark, "rolling-checkpoint")
    rows = deduped(spark, sf).select(*KEY, "reading_value").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows = stored(rows, "unique")
    stream = landed(spark, rows, F.least(F.floor((F.dayofmonth("timestamp") - 1) / 6), F.lit(4)), 5, "spans")
    rolling_batches(stream, target, checkpoint).awaitTermination()
    flush_rolling(spark, target, checkpoint)
    return spark.read.parquet(target)


@query
def stream_rolling_by_batches(spark, sf):
    return batched_features(spark, sf).select(
        "sensor_id", wall_clock(), r6("reading_value"), *[r6(c) for c in WINDOW_COLUMNS],
        "is_imputed", "peak_frequency", "anomaly_flag")


@query
def stream_alerts_by_batches(spark, sf):
    out = stream_alerts(batched_features(spark, sf))
    return out.select("sensor_id", wall_clock(), r6("reading_value"), r6("z_score"), "alert")


@query
def stream_scored_readings(spark, sf):
    """Hourly cells in four spans of days, scaled and correlated under statistics that grew in two steps."""
    rows = deduped(spark, sf, "hour").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows = stored(rows.select(*KEY, "reading_value"), "hours")
    folder, target = scratch(spark, "statistics"), scratch(spark, "scored")
    for early in (True, False):
        update_statistics(spark, folder, rows.where((F.dayofmonth("timestamp") <= 20) == early))
    stream = landed(spark, rows, F.floor((F.dayofmonth("timestamp") - 1) / 8), 4, "hours-landed")
    score_batches(stream, folder, target, scratch(spark, "scored-checkpoint")).awaitTermination()
    return spark.read.parquet(target).select(
        "sensor_id", wall_clock(), r6("reading_normalized"), r6("sensor_correlation"), r6("gas_concentration_est"))


@query
def stream_upsert_readings(spark, sf):
    """Keep-last over five micro-batches that hold rows of the same keys."""
    rows = readings(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    target = scratch(spark, "upserted")
    stream = landed(spark, rows, F.pmod(F.xxhash64("seq"), F.lit(5)), 5, "arrivals")
    upsert_batches(stream, target, scratch(spark, "upsert-checkpoint"), buckets=2).awaitTermination()
    return upserted(spark, target, rows.schema).select("sensor_id", wall_clock(), r6("reading_value"), "seq")


@query
def stream_dedup_keys(spark, sf):
    out = drained(spark, stream_dedup(event_stream(spark, sf, "minute").select(*KEY)), "dedup")
    return out.select("sensor_id", wall_clock())


@query
def stream_ingest_messages(spark, sf):
    landing, target = scratch(spark, "landing"), scratch(spark, "log")
    wide = vectors(spark, sf).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    wide.withColumn("source", F.lit("http_stream")).drop("vec_id").write.json(landing)
    run = ingest_messages(message_stream(spark, landing), target, scratch(spark, "log-checkpoint"))
    run.awaitTermination()
    rows = current_readings(spark, target)
    return rows.select("sensor_id", F.unix_micros("timestamp").alias("instant_us"), r6("reading_value"),
                       "source", "load_batch_id")
