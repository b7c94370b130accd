import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fumarole import schema, sinks, sources
from fumarole.functions import utc_text
from fumarole.operators import quality
from fumarole.plans import stages
from fumarole.settings import SENSORS


def wide(spark, rows=400, seed=42, source="batch"):
    rng = np.random.default_rng(seed)
    i = np.arange(rows)
    # A slow triangle wave of noise at every sensor's own level, one spike, one reading in 80 missing.
    wave = np.abs(i % 240 - 120) / 20
    data = {}
    for j, s in enumerate(SENSORS):
        level = wave + 50 * (j + 2) + 2.5 * rng.standard_normal(rows)
        level[250:251] += 55
        level[(i * 7 + j * 13) % 80 == 5] = np.nan
        data[s] = level
    at = pd.Timestamp("2025-01-01", tz="UTC") + pd.to_timedelta(i, unit="min")
    return spark.createDataFrame(pd.DataFrame({"timestamp": at, "source": source, **data}))


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    batch = sources.wide_to_long(wide(spark), "b")
    feed = sources.wide_to_long(wide(spark, 100, 1, "http_stream"), "s")
    raw = sources.union_sources([(batch, 0), (feed, 1)]).withColumn("seq", F.lit(0))
    out = str(tmp_path_factory.mktemp("layers"))
    return stages.run(raw, out, tables=True)


def test_final_table(spark, layers):
    final = spark.read.parquet(layers.final)
    assert set(schema.FINAL_COLUMNS) <= set(final.columns)
    assert len(schema.FINAL_COLUMNS) == 29
    types = dict(final.dtypes)
    assert all(types[c] == t for c, t in schema.SINK_TYPES.items())
    assert final.count() == 400 * 16 == final.select("sensor_id", "timestamp").distinct().count()
    # The feed overlaps the first 100 minutes and is the later source.
    assert final.where("source = 'http_stream'").count() == 100 * 16


def test_planted_spikes_are_found(spark, layers):
    final = spark.read.parquet(layers.final)
    spikes = final.where(F.unix_seconds("timestamp") == 1735689600 + 250 * 60)
    assert spikes.where("anomaly_flag = 1 or reading_value is null").count() >= 15
    assert spikes.where("ml_anomaly = 1").count() >= 14
    share = final.agg(F.avg("ml_anomaly")).first()[0]
    assert 0.025 < share <= 0.03


def test_other_outputs(spark, layers):
    report = sources.read_report(spark, layers.report).first()
    assert report["success"] and report["sensor_count"] == 16
    alerts = spark.read.option("header", True).csv(layers.alerts)
    final = spark.read.parquet(layers.final)
    assert alerts.count() == final.where("ml_anomaly = 1").count() == spark.table("anomaly_alerts").count()
    assert spark.table("sensor_readings_curated").count() == final.count()
    assert sinks.load_model(spark, layers.model).select("tree_id").distinct().count() == 150
    parts = [d for d in os.listdir(layers.partitioned) if d.startswith("reading_date=")]
    assert parts == ["reading_date=2025-01-01"]
    windows = spark.read.parquet(layers.windows)
    assert {"spark_rolling_avg", "spark_moving_std", "spark_max", "spark_min", "spark_rate_of_change"} <= set(windows.columns)


def test_bad_data_is_not_published(spark, tmp_path):
    raw = sources.wide_to_long(wide(spark, 60), "b").where("sensor_id <> 'S16'")
    raw = raw.withColumns({"priority": F.lit(0), "seq": F.lit(0)})
    with pytest.raises(ValueError, match="consistency"):
        stages.run(raw, str(tmp_path / "out"))
    assert not os.path.exists(tmp_path / "out" / "partitioned") and not os.path.exists(tmp_path / "out" / "alerts")
    assert spark.read.parquet(str(tmp_path / "out" / "raw")).count() == raw.count()
    report = sources.read_report(spark, str(tmp_path / "out" / "report"))
    with pytest.raises(ValueError):
        quality.enforce(report)


def test_session_time_zone_does_not_matter(spark):
    raw = sources.wide_to_long(wide(spark, 80), "b").withColumns({"priority": F.lit(0), "seq": F.lit(0)})
    before = spark.conf.get("spark.sql.session.timeZone")
    got = []
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = stages.features(stages.cleaned(raw), block_rows=20)
            got.append(sorted(map(tuple, rows.select(
                "sensor_id", F.unix_seconds("timestamp"), "rolling_avg", "peak_frequency", "sensor_correlation",
                "hour_of_day", "is_weekend", "reading_date",
            ).collect())))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[0] == got[1]
    assert {r[-1] for r in got[0]} == {"2025-01-01"} and {r[-3] for r in got[0]} == {0, 1}


def test_instants_as_text_are_utc(spark):
    micros = [0, -1, 1_735_689_600_000_000, 1_711_846_799_999_999, 951_782_400_500_000]
    rows = spark.createDataFrame([(m,) for m in micros], "m long").withColumn("t", F.timestamp_micros("m"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = {r["m"]: r["text"] for r in rows.select("m", utc_text(F.col("t")).alias("text")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {m: pd.Timestamp(m, unit="us").strftime("%Y-%m-%dT%H:%M:%S.%fZ") for m in micros}


def test_malformed_lines_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("\n".join([",".join(f"a{k}" for k in range(16)), *[",".join(str(k + i % 7) for k in range(16)) for i in range(60)]]))
    good = json.dumps({"timestamp": "2025-01-01T00:03:00+00:00", "source": "x", **{s: 1.0 for s in SENSORS}})
    (tmp_path / "http.jsonl").write_text("\n".join([good, "{bad", good]))
    (tmp_path / "mqtt.jsonl").write_text('{"timestamp": \n')
    feeds = [str(tmp_path / f"{n}.jsonl") for n in ("http", "mqtt", "received")]
    raw, bad = stages.load_with_bad(spark, str(tmp_path / "wide.csv"), feeds)
    assert raw.count() == 16 * (60 + 2)
    at = stages.run(raw, str(tmp_path / "out"), strict=False, bad=bad)
    kept = sorted((r["path"], r["seq"], r["_corrupt_record"].strip()) for r in spark.read.parquet(at.quarantine).collect())
    assert kept == [(feeds[0], 1, "{bad"), (feeds[1], 0, '{"timestamp":')]
    assert sources.read_report(spark, at.report).first()["quarantined_lines"] == 2


def test_dynamic_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "p")
    first = spark.createDataFrame([("2025-01-01", 1), ("2025-01-02", 2)], "reading_date string, v int")
    second = spark.createDataFrame([("2025-01-02", 20), ("2025-01-03", 30)], "reading_date string, v int")
    sinks.write_partitioned(first, path)
    sinks.write_partitioned(second, path, mode="dynamic")
    back = {str(r["reading_date"]): r["v"] for r in spark.read.parquet(path).collect()}
    assert back == {"2025-01-01": 1, "2025-01-02": 20, "2025-01-03": 30}
    sinks.write_partitioned(second, path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        sinks.write_partitioned(second, path, mode="append")


def test_raw_files_to_features(spark, tmp_path):
    """The last line of the last feed wins; an absent feed is no error."""
    header = ",".join([f"a{k}" for k in range(16)] + ["class"])
    lines = [",".join([f"{k}:{100 * k + i}" for k in range(16)] + ["3"]) for i in range(50)]
    (tmp_path / "wide.csv").write_text("\n".join([header, *lines]))

    def message(minute, value):
        return json.dumps({"timestamp": f"2025-01-01T00:{minute:02d}:00+00:00", "source": "x",
                           **{s: value for s in SENSORS}})

    (tmp_path / "http.jsonl").write_text("\n".join([message(3, 1.0), "", message(3, 2.0), message(4, 5.0)]))
    (tmp_path / "mqtt.jsonl").write_text(message(4, None) + "\n" + message(50, 7.0) + "\n{bad")
    feeds = [str(tmp_path / f"{n}.jsonl") for n in ("http", "mqtt", "received")]
    raw = stages.load_raw(spark, str(tmp_path / "wide.csv"), feeds)
    assert raw.count() == 16 * (50 + 3 + 2)
    rows = stages.cleaned(raw).where("sensor_id = 'S02'").orderBy("timestamp").collect()
    assert len(rows) == 51
    assert [r["reading_value"] for r in rows[:6]] == [100, 101, 102, 2, 2, 105]
    assert rows[4]["is_imputed"] == 1 and rows[50]["reading_value"] == 7


def test_csv_layers_and_new_partitions_beside_old_ones(spark, tmp_path):
    raw = sources.wide_to_long(wide(spark, 60), "b").withColumns({"priority": F.lit(0), "seq": F.lit(0)})
    out = str(tmp_path / "out")
    first = stages.run(raw, out, csv=True)
    before = sinks.versions.read_current(spark, f"{out}/partitioned")
    n = before.count()
    for path in (first.raw_csv, first.curated_csv):
        assert spark.read.option("header", True).csv(path).count() == n == 60 * 16
    bad = raw.where("sensor_id <> 'S16'")
    with pytest.raises(ValueError, match="consistency"):
        stages.run(bad, out)
    assert sinks.versions.current(spark, f"{out}/partitioned") == first.partitioned
    again = stages.run(raw, out)
    assert again.partitioned != first.partitioned and before.count() == n
    assert sinks.versions.read_current(spark, f"{out}/partitioned").count() == n
