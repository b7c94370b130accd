"""Size checks, bounded lookups and stored intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fumarole.settings import LOOKUP_ROWS, SMALL_BYTES


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, which costs no job; None when there is none."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return None


def is_small(df: DataFrame, limit: int = SMALL_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def bounded_rows(df: DataFrame, max_rows: int = LOOKUP_ROWS) -> DataFrame | None:
    """``df`` as a local relation if it has at most ``max_rows`` rows, else None.

    Never more than ``max_rows + 1`` rows reach the driver, and the aggregate
    behind ``df`` is not computed a second time when it is joined.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def small_side(stats: DataFrame, max_rows: int = LOOKUP_ROWS) -> DataFrame | None:
    """``stats`` ready to broadcast, its size checked; None when it is too large."""
    if is_small(stats):
        return F.broadcast(stats)
    local = bounded_rows(stats, max_rows)
    return None if local is None else F.broadcast(local)


def lookup(df: DataFrame, stats: DataFrame, keys: list[str], max_rows: int = LOOKUP_ROWS) -> DataFrame:
    """Left join of per-group ``stats`` onto the rows of ``df``.

    Broadcast only within the checked bound. Beyond it, a shuffle join in which
    every group is spread over salts, so a group holding a third of the rows
    does not end in one task.
    """
    side = small_side(stats, max_rows)
    return salted_join(df, stats, keys) if side is None else df.join(side, keys, "left")


def salted_join(df: DataFrame, stats: DataFrame, keys: list[str], salts: int = 32) -> DataFrame:
    others = [c for c, t in df.dtypes if c not in keys and not t.startswith(("map", "variant"))]
    spread = F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int") if others else F.lit(0)
    copies = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("_salt", spread).join(copies, keys + ["_salt"], "left").drop("_salt")


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    A folder of our own is made only for a local master, as in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="fumarole-")
    return _own_dirs[app]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage for consumers that pass over the rows several times; the
    files outlive any executor.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_if_large(df: DataFrame, name: str) -> DataFrame:
    """``stored`` unless computing the rows again costs next to nothing."""
    return df if is_small(df) else stored(df, name)
