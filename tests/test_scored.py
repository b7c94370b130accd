import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from fumarole import streaming
from fumarole.catalog.queries import QUERIES
from fumarole.operators import clean, cross, model
from fumarole.sinks import versions

SCHEMA = "sensor_id string, timestamp timestamp, reading_value double, score double"


def readings(spark, n=120, sensors=5, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(f"S{k}", 1_735_689_600 + 60 * i, None if rng.random() < 0.2 else float(rng.normal(k, 1)), float(rng.random()))
            for i in range(n) for k in range(sensors)]
    rows += [("S9", 1_735_689_600 + 60 * i, 3.0, 0.0) for i in range(n)]  # without variation
    df = spark.createDataFrame(rows, "sensor_id string, t long, reading_value double, score double")
    return df.select("sensor_id", F.timestamp_seconds("t").alias("timestamp"), "reading_value", "score")


def minute(df):
    return (F.unix_seconds("timestamp") - 1_735_689_600) / 60


def values(df):
    columns = ["sensor_id", "timestamp", "reading_normalized", "sensor_correlation", "gas_concentration_est", "ml_anomaly"]
    return {(r[0], r[1]): r[2:] for r in df.select(*columns).collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9, nan_ok=True), k


def batch(rows, cut):
    flagged = model.flag_above(clean.minmax_normalize(rows), cut, "score")
    return cross.cross_features(flagged)


def test_batches_scored_under_versions_equal_batch(spark, tmp_path):
    rows = readings(spark).cache()
    folder, target, checkpoint = (str(tmp_path / n) for n in ("statistics", "out", "checkpoint"))

    def span(first, last):
        return rows.where(minute(rows).between(first, last))

    streaming.update_statistics(spark, folder, span(0, 59), cut=0.9)
    for k, (first, last) in enumerate(((0, 29), (30, 59), (60, 89), (90, 119))):
        span(first, last).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if k == 2:  # later batches are scored under a longer history and another cut
            streaming.update_statistics(spark, folder, span(60, 119), cut=0.8)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        streaming.score_batches(stream, folder, target, checkpoint, "score").awaitTermination()
    out = spark.read.parquet(target)
    one, two = versions.versions(spark, folder)
    assert {(r[0], r[1]) for r in out.select("batch_no", "statistics_version").distinct().collect()} == {(0, one), (1, one), (2, two), (3, two)}
    same(values(out.where("batch_no < 2")), values(batch(span(0, 59), 0.9)))
    want = values(batch(rows, 0.8))
    late = {(r[0], r[1]) for r in span(60, 119).select("sensor_id", "timestamp").collect()}
    same(values(out.where("batch_no >= 2")), {k: v for k, v in want.items() if k in late})


def test_a_batch_run_again_keeps_its_version(spark, tmp_path):
    rows = readings(spark, 20)
    folder, checkpoint = str(tmp_path / "statistics"), str(tmp_path / "checkpoint")
    first = streaming.update_statistics(spark, folder, rows)
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    for target in ("a", "b"):  # the second run starts from the beginning, after an update, with the notes of the first
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        streaming.score_batches(stream, folder, str(tmp_path / target), checkpoint).awaitTermination()
        os.rename(f"{checkpoint}/stream", f"{checkpoint}/stream-{target}")
        streaming.update_statistics(spark, folder, rows.withColumn("reading_value", F.lit(1e6)))
    found = [spark.read.parquet(str(tmp_path / t)).select("statistics_version").distinct().collect() for t in "ab"]
    assert [[r[0] for r in f] for f in found] == [[first], [first]]


def test_unknown_sensors_and_readings_beyond(spark, tmp_path):
    folder = str(tmp_path / "statistics")
    rows = readings(spark, 10).where("sensor_id = 'S1'")
    streaming.update_statistics(spark, folder, rows)
    more = rows.limit(2).select(F.lit("new").alias("sensor_id"), "timestamp", F.lit(5.0).alias("reading_value")).unionByName(
        rows.limit(1).select("sensor_id", "timestamp", F.lit(1e9).alias("reading_value")))
    got = {r["sensor_id"]: r["reading_normalized"] for r in streaming.scored(more, streaming.statistics(spark, folder)).collect()}
    assert got["new"] == 0.0 and got["S1"] > 1


def test_model_alerts_are_the_flagged_rows(spark):
    sf = "/root/testdata/sf0.001"
    found = QUERIES["model_alerts"](spark, sf)
    assert found.columns == ["timestamp", "sensor_id", "reading_value", "z_score", "anomaly_score", "alert"]
    scored = QUERIES["iforest_score"](spark, sf).collect()
    cut = np.quantile([r["anomaly_score"] for r in scored], 0.97)
    want = {(r["timestamp"], r["sensor_id"]): r["anomaly_score"] for r in scored if r["anomaly_score"] > cut}
    rows = found.collect()
    assert {(r["timestamp"], r["sensor_id"]): r["anomaly_score"] for r in rows} == pytest.approx(want)
    assert [(r["timestamp"]) for r in rows] == sorted((r["timestamp"] for r in rows), reverse=True)
    assert {r["alert"] for r in rows} == {"SENSOR_ANOMALY"}
    assert QUERIES["recent_model_alerts_top100"](spark, sf).collect() == rows[:100]
