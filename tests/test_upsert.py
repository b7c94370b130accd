import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from fumarole import streaming
from fumarole.operators import clean
from fumarole.sinks import versions
from fumarole.streaming import upsert

SCHEMA = "sensor_id string, timestamp timestamp, reading_value double, seq long"


def arrivals(spark, batches, seed=1):
    """Readings of three days in several files, where a key comes again in other files."""
    rng = np.random.default_rng(seed)
    files = []
    for b in range(batches):
        rows = []
        for _ in range(300):
            minute = int(rng.integers(0, 200)) + 1440 * int(rng.integers(0, 3))
            rows.append((f"S{rng.integers(0, 5)}", 1_735_689_600 + 60 * minute, None if rng.random() < 0.2 else float(rng.normal()), int(rng.integers(0, 10**9))))
        rows += [(None, 1_735_689_600, 1.0, 1), ("S1", None, 1.0, 2)]
        df = spark.createDataFrame(rows, "sensor_id string, t long, reading_value double, seq long")
        files.append(df.select("sensor_id", F.timestamp_seconds("t").alias("timestamp"), "reading_value", "seq"))
    return files


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def rows(df):
    return sorted(map(tuple, df.select("sensor_id", "timestamp", "reading_value", "seq").collect()), key=repr)


def test_batches_equal_one_dedup(spark, tmp_path):
    files = arrivals(spark, 5)
    target, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    whole = None
    for k, part in enumerate(files):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        whole = part if whole is None else whole.unionByName(part)
        if k in (2, 4):  # three files, then two more, each a micro-batch
            streaming.upsert_batches(stream(spark, tmp_path / "in"), target, checkpoint, buckets=4).awaitTermination()
            want = clean.dedup_keep_last(whole, order=("seq",))
            assert rows(streaming.upserted(spark, target, want.schema)) == rows(want)
    assert len(versions.versions(spark, target)) == 3  # of five, the last are kept
    # Once more: nothing is new.
    streaming.upsert_batches(stream(spark, tmp_path / "in"), target, checkpoint, buckets=4).awaitTermination()
    assert rows(streaming.upserted(spark, target, want.schema)) == rows(want)


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    first, second, third = arrivals(spark, 3, 2)
    target, keys = str(tmp_path / "table"), list(clean.KEYS)

    def run(part, number):
        placed = upsert._placed(clean.dedup_keep_last(part, keys, ("seq",)), keys, 4)
        upsert.upsert(spark, placed, target, number, ("seq",), keys, part.columns)

    run(first, 0), run(second, 1)
    want = rows(clean.dedup_keep_last(first.unionByName(second), order=("seq",)))
    run(second, 1)
    assert rows(streaming.upserted(spark, target, first.schema)) == want
    # A batch that ended before its marker: its rows are not seen, and replaced when it is run again.
    run(third, 2)
    versions.remove(spark, f"{target}/{versions.MARKERS}/{upsert._name(2)}")
    assert rows(streaming.upserted(spark, target, first.schema)) == want
    run(third, 2)
    assert rows(streaming.upserted(spark, target, first.schema)) == rows(clean.dedup_keep_last(first.unionByName(second).unionByName(third), order=("seq",)))


def test_only_touched_buckets_are_written(spark, tmp_path):
    first, *_ = arrivals(spark, 1, 3)
    target, keys = str(tmp_path / "table"), list(clean.KEYS)
    for number, part in enumerate((first, first.where("day(timestamp) = 2").limit(1))):
        upsert.upsert(spark, upsert._placed(clean.dedup_keep_last(part, keys, ("seq",)), keys, 4), target, number, ("seq",), keys, part.columns)
    days = [d for d in os.listdir(f"{target}/rows/{upsert._name(1)}") if "=" in d]
    assert days == ["upsert_day=2025-01-02"] and len(os.listdir(f"{target}/rows/{upsert._name(1)}/{days[0]}")) == 1


def test_replaced_trees(spark, tmp_path):
    folder = str(tmp_path / "tree")
    with pytest.raises(FileNotFoundError):
        versions.current(spark, folder)
    for n in (1, 2, 3):
        versions.replace(spark, folder, lambda path: spark.range(n).write.parquet(path))
        assert versions.read_current(spark, folder).count() == n
    assert len(versions.versions(spark, folder)) == 2

    def killed(path):
        spark.range(99).write.parquet(path)
        raise RuntimeError("killed")

    old = versions.read_current(spark, folder)
    with pytest.raises(RuntimeError):
        versions.replace(spark, folder, killed)
    assert versions.read_current(spark, folder).count() == 3 == old.count()
    versions.replace(spark, folder, lambda path: spark.range(4).write.parquet(path))
    assert old.count() == 3 and versions.read_current(spark, folder).count() == 4
    versions.replace(spark, folder, lambda path: spark.range(5).write.parquet(path))
    assert len([d for d in os.listdir(folder) if d != versions.MARKERS]) == 2
