import pytest
from pyspark.sql import functions as F

from fumarole.operators import quality, summary


def table(spark, n_sensors=16, rows=20):
    return spark.range(n_sensors * rows).select(
        F.format_string("S%02d", F.pmod("id", F.lit(n_sensors)) + 1).alias("sensor_id"),
        F.timestamp_seconds((F.col("id") / n_sensors).cast("int") * 60).alias("timestamp"),
        F.lit(100.0).cast("float").alias("reading_value"),
        F.lit(0.5).alias("reading_normalized"), F.lit(0).alias("anomaly_flag"))


def test_good_data_passes(spark):
    row = quality.enforce(quality.report(table(spark))).first()
    assert row["success"] and row["row_count"] == 320 and row["sensor_count"] == 16
    assert row["missing_rate"] == 0 and row["duplicate_sensor_timestamp_rows"] == 0


@pytest.mark.parametrize("column,value,rule", [
    ("sensor_id", None, "sensor_id_non_null"),
    ("timestamp", None, "timestamp_non_null"),
    ("reading_value", None, "reading_value_non_null"),
    ("reading_value", 70001.0, "reading_range"),
    ("reading_normalized", 1.5, "normalized_range"),
    ("anomaly_flag", 2, "anomaly_binary"),
])
def test_one_bad_row_breaks_its_rule(spark, column, value, rule):
    good = table(spark)
    hit = (F.col("sensor_id") == "S03") & (F.unix_seconds("timestamp") == 60)
    kind = good.schema[column].dataType
    bad = good.withColumn(column, F.when(hit, F.lit(value).cast(kind)).otherwise(F.col(column)))
    rules = {r["name"]: r for r in quality.check(bad).collect()}
    assert [n for n, r in rules.items() if not r["success"]] == [rule]
    assert rules[rule]["unexpected_count"] == 1 and rules[rule]["element_count"] == 320
    assert quality.offenders(bad).select("name").first()[0] == rule
    with pytest.raises(ValueError, match=rule):
        quality.enforce(quality.report(bad))


def test_limits_are_inclusive_and_nulls_pass_ranges(spark):
    df = table(spark).withColumn("reading_value", F.when(F.col("sensor_id") == "S01", F.lit(-5000.0)).when(
        F.col("sensor_id") == "S02", F.lit(70000.0)))
    rules = {r["name"]: r for r in quality.check(df).collect()}
    assert rules["reading_range"]["success"] and rules["reading_range"]["missing_count"] == 280
    assert not rules["reading_value_non_null"]["success"]


def test_duplicates_and_sensor_count(spark):
    df = table(spark, n_sensors=15)
    twice = df.unionByName(df.where("sensor_id = 'S01'"))
    row = quality.report(twice).first()
    assert row["duplicate_sensor_timestamp_rows"] == 20 and row["sensor_count"] == 15
    assert not row["consistency_ok"] and not row["success"]
    with pytest.raises(ValueError, match="consistency"):
        quality.enforce(quality.report(df))
    assert quality.report(df, expected_sensors=15).first()["success"]
    assert summary.duplicate_keys(twice).first()[0] == 20


def test_empty_table(spark):
    row = quality.report(table(spark).limit(0)).first()
    assert row["row_count"] == 0 and row["missing_rate"] is None and not row["success"]


def test_kpis(spark):
    df = table(spark).withColumns({
        "ml_anomaly": (F.col("sensor_id") == "S01").cast("int"),
        "reading_value": F.when(F.col("sensor_id") != "S02", F.col("reading_value"))})
    row = summary.kpi_summary(df).first()
    assert tuple(row) == (320, 16, 20, 20 / 320, 20 / 320)


def test_tail_and_recent(spark):
    df = table(spark)
    tail = summary.sensor_tail(df, "S05", 7).collect()
    assert len(tail) == 7 and [r["timestamp"] for r in tail] == sorted(r["timestamp"] for r in tail)
    assert {r["sensor_id"] for r in tail} == {"S05"}
    recent = summary.recent_alerts(df, 20).collect()
    assert len(recent) == 20 and [r["sensor_id"] for r in recent[:16]] == sorted(r["sensor_id"] for r in recent[:16])
    assert [r[0] for r in summary.distinct_sensors(df).collect()] == [f"S{k:02d}" for k in range(1, 17)]
