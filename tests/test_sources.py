import datetime as dt
import json

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fumarole import sources
from fumarole.functions import finite, indexed_value, parse_instant, weekend
from fumarole.plans import sizing
from fumarole.plans.rowindex import with_row_index
from fumarole.settings import SENSORS
from fumarole.sources import reshape


def cells(spark, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    out = rows.select("i", indexed_value(F.col("c")).alias("n")).orderBy("i").collect()
    return [r["n"] for r in out]


def test_cell_parsing(spark):
    got = cells(spark, ["1:0.5", " 3:1e2 ", "nan", "abc", "", None, "1.0d", "1_000", "5", "-2:.5", "1:2:3", "\t7\n", "1:"])
    assert got == [0.5, 100.0, None, None, None, None, None, 1000.0, 5.0, 0.5, 3.0, 7.0, None]


def test_infinite_cells(spark):
    assert cells(spark, ["inf", "1:-Infinity"]) == [float("inf"), float("-inf")]
    rows = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.5,), (None,)], "x double")
    assert [r[0] for r in rows.select(finite(F.col("x"))).collect()] == [None, None, 1.5, None]


@pytest.mark.parametrize("n,first", [(130, [0, 9, 18, 26, 34]), (128, [0, 8, 16, 24, 32]), (16, [0, 1, 2, 3, 4])])
def test_channel_starts(n, first):
    starts = sources.channel_starts(n)
    assert starts[:5] == first and len(starts) == 16
    assert starts == [len(b) and int(b[0]) for b in __import__("numpy").array_split(range(n), 16)]


def write_wide(path, n_rows, n_columns, start=0):
    header = [f"a{k}" for k in range(n_columns)] + ["Class"]
    lines = [",".join(header)]
    for i in range(start, start + n_rows):
        row = [f"{k}:{i + k / 100}" if k != 2 else "x" for k in range(n_columns)]
        lines.append(",".join(row + ["1"]))
    path.write_text("\n".join(lines) + "\n")


def test_wide_csv_to_long(spark, tmp_path):
    write_wide(tmp_path / "w.csv", 40, 33)
    wide = sources.canonicalize(sources.read_wide_csv(spark, str(tmp_path / "w.csv")))
    assert wide.columns == ["timestamp", "source", *SENSORS]
    rows = wide.orderBy("timestamp").collect()
    # Column a2 holds no number, so 32 usable columns make 16 blocks of two.
    usable = [k for k in range(33) if k != 2]
    assert [rows[7][s] for s in SENSORS] == [7 + usable[2 * k] / 100 for k in range(16)]
    assert [r["timestamp"] for r in rows] == sorted({r["timestamp"] for r in rows})
    first = wide.agg(F.min(F.unix_seconds("timestamp"))).first()[0]
    assert first == dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc).timestamp()

    long = sources.wide_to_long(wide, "b1")
    assert long.count() == 40 * 16
    assert long.columns == ["sensor_id", "timestamp", "reading_value", "gas_type", "unit", "source",
                            "ingestion_timestamp", "load_batch_id"]
    assert long.select("ingestion_timestamp").distinct().count() == 1


def test_too_few_columns(spark, tmp_path):
    write_wide(tmp_path / "w.csv", 3, 15)
    with pytest.raises(ValueError, match="at least 16"):
        sources.canonicalize(sources.read_wide_csv(spark, str(tmp_path / "w.csv")))


def test_row_index_survives_other_splits(spark, tmp_path, monkeypatch):
    """Splits that change between the plan and its run, and offsets from a job of their own."""
    monkeypatch.setattr(sizing, "is_small", lambda *a, **k: False)
    path, key = str(tmp_path / "wide.csv"), "spark.sql.files.maxPartitionBytes"
    spark.range(40_000).selectExpr("id as a0", "id * 3 as a1").coalesce(1).write.csv(path, header=True)
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64000")
        rows = with_row_index(spark.read.csv(path, header=True, schema="a0 long, a1 long"))
        spark.conf.set(key, "9000000")
        found = rows.agg(F.count("row_index").alias("n"), F.count_if(F.col("row_index") != F.col("a0")).alias("moved")).first()
    finally:
        spark.conf.set(key, before)
    assert (found["n"], found["moved"]) == (40_000, 0)


def test_row_index_follows_files_and_splits(spark, tmp_path):
    for k, n in enumerate([1000, 1, 500]):
        write_wide(tmp_path / f"part{k}.csv", n, 16, start=10_000 * k)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = sources.read_wide_csv(spark, str(tmp_path))
        assert scan.rdd.getNumPartitions() > 5
        rows = with_row_index(scan.select("a0")).orderBy("row_index").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["row_index"] for r in rows] == list(range(1501))
    expected = [f"0:{float(i)}" for i in (*range(1000), 10_000, *range(20_000, 20_500))]
    assert [r["a0"] for r in rows] == expected


def test_positional_join_keeps_the_longer_side(spark, tmp_path):
    spark.createDataFrame([(i,) for i in range(5)], "x int").coalesce(1).write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([(i * 10,) for i in range(3)], "y int").coalesce(1).write.parquet(str(tmp_path / "y"))
    out = sources.positional_join(spark.read.parquet(str(tmp_path / "x")), spark.read.parquet(str(tmp_path / "y")))
    got = [(r["x"], r["y"]) for r in out.orderBy("row_index").collect()]
    assert got == [(0, 0), (1, 10), (2, 20), (3, None), (4, None)]


def test_messages(spark, tmp_path):
    good = {"timestamp": "2025-01-01T00:00:00+00:00", "source": "http_stream", "S01": 1.5, "S02": None, "S03": "bad",
            "_received_at": "2025-01-01T00:00:01+00:00"}
    lines = [json.dumps(good), "", "not json", json.dumps({**good, "timestamp": "never"})]
    path = tmp_path / "http_stream.jsonl"
    path.write_text("\n".join(lines))
    raw = sources.read_messages(spark, [str(path), str(tmp_path / "absent.jsonl")])
    raw.cache()
    assert raw.count() == 3
    assert raw.where("_corrupt_record is not null").count() == 1
    rows = sources.message_frame(raw).orderBy(F.desc_nulls_last("timestamp")).collect()
    assert len(rows) == 2
    assert rows[0]["S01"] == 1.5 and rows[0]["S02"] is None and rows[0]["S03"] is None
    assert rows[1]["timestamp"] is None
    assert sources.read_messages(spark, [str(tmp_path / "absent.jsonl")]).count() == 0
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_messages(spark, str(path), on_bad="fail").collect()


def test_message_numbers_skip_blank_lines(spark, tmp_path):
    path = tmp_path / "feed.jsonl"
    lines = []
    for i in range(300):
        lines += [json.dumps({"timestamp": "2025-01-01T00:00:00Z", "source": "s", "S01": i})] + [""] * (i % 4)
    path.write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        rows = sources.read_messages(spark, str(path), ("S01",), number="seq")
        assert rows.rdd.getNumPartitions() > 2
        got = [(r["seq"], int(r["S01"])) for r in rows.orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i, i) for i in range(300)]
    assert sources.read_messages(spark, str(tmp_path / "absent"), number="seq").columns[-1] == "seq"


def test_union_marks_priority_and_fills_columns(spark):
    a = spark.createDataFrame([("S01", 1)], "sensor_id string, v int")
    b = spark.createDataFrame([("S02", "x")], "sensor_id string, note string")
    rows = sources.union_sources([(a, 0), (b, 10)]).orderBy("priority").collect()
    assert [(r["sensor_id"], r["v"], r["note"], r["priority"]) for r in rows] == [
        ("S01", 1, None, 0), ("S02", None, "x", 10)]


def test_nanosecond_parquet(spark, tmp_path):
    at = pd.Timestamp("2024-01-02 03:04:05.123456789")
    table = pa.table({"t": pa.array([at.value, -1], pa.timestamp("ns")), "v": [1, 2]})
    pq.write_table(table, str(tmp_path / "n.parquet"), version="2.6")
    rows = sources.read_parquet_any(spark, str(tmp_path / "n.parquet"), ["t"])
    got = [r[0] for r in rows.orderBy("v").select(F.unix_micros("t")).collect()]
    assert got == [at.value // 1000, -1]


def test_instants_and_weekend(spark):
    texts = ["2025-01-04T10:00:00Z", "2025-01-06T00:00:00.5+05:30", "bad", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = [r[0] for r in rows.select(F.unix_millis(parse_instant(F.col("t")))).collect()]
    assert got == [1735984800000, 1736101800500, None, None]
    # Without a zone the text is UTC, whatever the session says.
    before = spark.conf.get("spark.sql.session.timeZone")
    plain = ["2025-01-04T10:00:00", "2025-01-04 10:00:00.25", "2025-01-04", "2025-01-04T10:00:00-02:00",
             "2025-01-04T10:00Z", "2025-03-09 02:30:00"]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = spark.createDataFrame(list(enumerate(plain)), "i int, t string").orderBy("i")
        got = [r[0] for r in rows.select(F.unix_millis(parse_instant(F.col("t")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [1735984800000, 1735984800250, 1735948800000, 1735992000000, 1735984800000, 1741487400000]
    days = spark.sql("select timestamp_ntz'2025-01-04 00:00:00' a, timestamp_ntz'2025-01-06 00:00:00' b")
    assert days.select(weekend(F.col("a")), weekend(F.col("b"))).first()[:] == (1, 0)


def test_columns_that_show_a_number_late_are_found(spark, monkeypatch):
    rows = [(str(i), "x", "7:1.5" if i == 4000 else "none", None) for i in range(5000)]
    df = spark.createDataFrame(rows, "a string, b string, `c.d` string, e string").repartition(5)
    read = []
    real = reshape.usable_counts
    monkeypatch.setattr(reshape, "usable_counts", lambda part, of: read.append(list(of)) or real(part, of))
    assert reshape.usable_names(df, df.columns) == {"a", "c.d"}
    assert read[0] == df.columns and "a" not in read[1] and len(read) == 2
    assert reshape.usable_names(df.select("a"), ["a"]) == {"a"} and len(read) == 3
