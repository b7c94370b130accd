"""What the corpus operators share: words, hashes, stored stages, column names."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fumarole.plans import sizing

#: A word is a run of anything but ASCII white space; bytes.split() finds the same runs.
WORD = r"[^\x20\x09-\x0D]+"
#: Frees the shuffle files of a finished write, so that stages do not add up on the disks.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Texts that a task holds as Python objects at a time, unless a single one is longer.
BATCH_BYTES = 2 << 20
#: Rows that go to a Python worker at a time: their Arrow buffers stand in both processes and are not part of the heap.
BATCH_ROWS = 2000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; its shuffle files go at once."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return sizing.stored(df, name)
    finally:
        conf.set(CLEANUP, before)


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's rows to a Python worker at a time to BATCH_ROWS, unless they are fewer.

    It stays set, since a result is computed when its caller writes it.
    """
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or one derived from it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids that no model may learn from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's last steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, width: int, seed: int = 0, factor: np.uint64 = GOLDEN) -> np.ndarray:
    """One 64-bit hash for every run of ``width`` words; none when there are fewer words.

    Hashes under different factors are independent, those under different seeds only differ.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(seed * 2 + 1))
    for j in range(width):
        out = out * factor + hashes[j:n + j]
    return mix(out)


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most BATCH_BYTES of ``column``, or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + BATCH_BYTES, "right")))
            yield batch.slice(at, to - at)
            at = to


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
