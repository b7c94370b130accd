"""What a Python worker holds at a time."""

import tracemalloc

import pyarrow as pa

from fumarole.llm import substrings
from fumarole.llm.common import ARROW_ROWS, BATCH_ROWS, bound_batches


def peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_rows_to_a_worker_are_bounded(spark):
    before = spark.conf.get(ARROW_ROWS)
    try:
        for given, want in (("10000", BATCH_ROWS), ("0", BATCH_ROWS), ("7", 7)):
            spark.conf.set(ARROW_ROWS, given)
            bound_batches(spark)
            assert int(spark.conf.get(ARROW_ROWS)) == want
        spark.conf.set(ARROW_ROWS, "10000")
        substrings.without_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
        assert int(spark.conf.get(ARROW_ROWS)) == BATCH_ROWS
    finally:
        spark.conf.set(ARROW_ROWS, before)


def test_windows_of_a_batch_take_little():
    words = [f"w{i % 5000}" for i in range(400)]
    texts = [" ".join(words[i % 400:] + words[:i % 400]) for i in range(4000)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array(texts), pa.array([list(range(390))] * len(texts), pa.list_(pa.int32()))], names=["doc_id", "text", "anchors"])

    def work():
        rows = sum(out.num_rows for out in substrings._window_rows(20)(iter([batch])))
        assert rows == 381 * len(texts)

    assert peak_mb(work) < 100
