"""The whole job: raw readings to cleaned, features, scores, alerts and report."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fumarole import sources
from fumarole.functions import utc_text
from fumarole.operators import model, quality
from fumarole.operators.clean import clean_windows, dedup_keep_last, minmax_normalize
from fumarole.operators.cross import cross_features
from fumarole.operators.windows import sliding_window_aggregates, window_features, with_reading_date
from fumarole.plans.sizing import stored_if_large
from fumarole.schema import CORRUPT
from fumarole.settings import N_CHANNELS, SENSORS
from fumarole.sinks import versions
from fumarole.sinks import (
    as_stored, save_model, save_table, write_csv, write_json, write_parquet, write_partitioned,
)


def load_raw(spark: SparkSession, wide_csv: str, feeds=(), channels=tuple(SENSORS)) -> DataFrame:
    """Long readings of a wide CSV and of message files; later feeds win over earlier ones.

    Malformed lines are not among them; ``load_with_bad`` has them too.
    """
    return load_with_bad(spark, wide_csv, feeds, channels)[0]


def load_with_bad(spark: SparkSession, wide_csv: str, feeds=(), channels=tuple(SENSORS)) -> tuple[DataFrame, DataFrame]:
    """``load_raw`` and the malformed lines of the message files: path, seq, _corrupt_record."""
    bad = spark.createDataFrame([], f"path string, seq long, {CORRUPT} string")
    batch = sources.canonicalize(sources.read_wide_csv(spark, wide_csv), channels)
    parts = [(sources.wide_to_long(batch, "batch", channels).withColumn("seq", F.lit(0).cast("long")), 0)]
    for priority, path in enumerate(feeds, 1):
        lines = sources.read_messages(spark, path, channels, number="seq")
        bad = bad.unionByName(lines.where(F.col(CORRUPT).isNotNull()).select(F.lit(path).alias("path"), "seq", CORRUPT))
        messages = sources.message_frame(lines, channels)
        parts.append((sources.wide_to_long(messages, "stream", channels, keep=["seq"]), priority))
    return sources.union_sources(parts), bad


def cleaned(raw: DataFrame, order=("priority", "seq"), block_rows: int | None = None) -> DataFrame:
    """Dedup, short-gap fill, rolling outliers, scaling, date."""
    # Block layout, extremes and windows all pass over these rows.
    unique = stored_if_large(dedup_keep_last(raw, order=order), "unique")
    rows = clean_windows(unique, block_rows=block_rows)
    return with_reading_date(minmax_normalize(rows, extremes_of=unique))


def features(clean: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Per-sensor window features, then the features across sensors."""
    return cross_features(window_features(clean, block_rows=block_rows))


@dataclass
class Layers:
    """Where ``run`` wrote what."""

    raw: str
    quarantine: str
    cleaned: str
    features: str
    final: str
    partitioned: str
    alerts: str
    model: str
    report: str
    windows: str
    raw_csv: str
    curated_csv: str


def run(raw: DataFrame, out: str, order=("priority", "seq"), expected_sensors: int = N_CHANNELS,
        tables: bool = False, strict: bool = True, bad: DataFrame | None = None, csv: bool = False) -> Layers:
    """Run every stage. A stage reads what the stage before stored, so none is computed twice.

    Data that fails the quality rules is not published: with ``strict`` the job ends after the
    report, and earlier partitions, alerts and tables stay as they are. ``bad``, the malformed
    lines of ``load_with_bad``, goes to the quarantine beside the raw layer; the report has their
    number, null where ``bad`` is not given. The partitions are a new version of ``partitioned``: who
    reads them through ``versions.read_current`` sees the old ones or the new ones, never a part.
    ``csv`` writes the raw and the curated readings as CSV too.
    """
    spark = raw.sparkSession
    at = Layers(**{name: f"{out}/{name}" for name in Layers.__dataclass_fields__})

    write_parquet(raw, at.raw)
    n_bad = None
    if bad is not None:
        write_parquet(bad, at.quarantine)
        n_bad = spark.read.parquet(at.quarantine).count()
    raw = spark.read.parquet(at.raw)
    write_parquet(as_stored(cleaned(raw, order)), at.cleaned)
    clean = spark.read.parquet(at.cleaned)
    write_parquet(sliding_window_aggregates(clean), at.windows)
    write_parquet(as_stored(features(clean)), at.features)
    rows = spark.read.parquet(at.features)

    save_model(model.fit_iforest(rows), at.model)
    nodes = spark.read.parquet(at.model)
    scored = f"{out}/scored"
    write_parquet(model.score_iforest(rows, nodes), scored)
    write_parquet(as_stored(model.flag_top(spark.read.parquet(scored))), at.final)
    final = spark.read.parquet(at.final)

    result = quality.report(final, expected_sensors=expected_sensors)
    write_json(result.withColumn("quarantined_lines", F.lit(n_bad).cast("long")), at.report)
    if strict:
        quality.enforce(spark.read.json(at.report))
    at.partitioned = versions.replace(spark, at.partitioned, lambda path: write_partitioned(final, path))
    found = model.alerts(final)
    write_csv(found.withColumn("timestamp", utc_text(F.col("timestamp"))), at.alerts)
    if csv:
        for rows, path in ((raw, at.raw_csv), (final, at.curated_csv)):
            write_csv(rows.withColumns({c: utc_text(F.col(c)) for c, kind in rows.dtypes if kind == "timestamp"}), path)
    if tables:
        save_table(raw, "sensor_readings_raw")
        save_table(final, "sensor_readings_curated")
        save_table(found, "anomaly_alerts")
    return at
