"""Shapes of plans: shuffles, pruning, pushdown, no nested loops."""

import re

import pytest
from pyspark.sql import functions as F

from fumarole.catalog.queries import QUERIES
from fumarole.operators import clean, cross, quality, summary, windows

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|range|single|Round)", plan_of(df)))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    rows = spark.range(2000).select(
        F.format_string("S%02d", F.pmod("id", F.lit(16)) + 1).alias("sensor_id"),
        F.timestamp_seconds((F.col("id") / 16).cast("int") * 60).alias("timestamp"),
        F.rand(1).cast("float").alias("reading_value"), F.rand(2).alias("reading_normalized"),
        F.lit("x").alias("unused"))
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_one_shuffle_for_all_window_features(table):
    assert exchanges(windows.window_features(table)) == 1
    assert exchanges(windows.window_features(clean.clean_windows(table))) == 1


def test_dedup_needs_one_shuffle(table):
    assert exchanges(clean.dedup_keep_last(table, order=("reading_value",))) == 1


def test_only_needed_columns_are_read(table):
    plan = plan_of(windows.rolling_stats(table).select("sensor_id", "timestamp", "rolling_avg"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "unused" not in schema and "reading_normalized" not in schema


def test_sensor_filter_reaches_the_scan(table):
    plan = plan_of(summary.sensor_tail(windows.window_features(table), "S01", 10))
    assert "EqualTo(sensor_id,S01)" in plan and "TakeOrderedAndProject" in plan


def test_top_k_does_not_sort_everything(table):
    assert "TakeOrderedAndProject" in plan_of(summary.recent_alerts(table))


def test_per_instant_features_aggregate_before_the_shuffle(table):
    plan = plan_of(cross.sensor_correlation(table))
    assert "partial_covar_pop" in plan and "BroadcastHashJoin" in plan


def test_quality_rules_shuffle_no_rows(table):
    plan = plan_of(quality.check(table.withColumn("anomaly_flag", F.lit(0))))
    assert exchanges(table) == 0 and re.findall(r"Exchange (\w+)", plan) == ["SinglePartition"]


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_nested_loop_or_cartesian_product(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "BatchEvalPython" not in plan
