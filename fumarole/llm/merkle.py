"""Merkle manifest of a dataset by slot pivots.

Nodes of one level are numbered within their group; a parent is a run of ``fanout`` of them. One
aggregation spreads the children of every parent into ``fanout`` slot columns by conditional
aggregates. The concatenated columns hash to the parent; without the own column they are a child's
siblings, cut in two at its place. Groups have trees of their own, whose tops are the leaves of one
more tree. Every aggregation and join has keys of at most ``fanout`` rows, so a group with a third
of all rows is as good as any other. A level is a sixteenth of the one below; the driver sees how
many nodes the largest group has left, and the root.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fumarole.llm.common import stored
from fumarole.plans.sizing import lookup

FANOUT = 16
A_Z, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a verifier needs of one level: the digests before and after the own one.
STEP = "struct<before: string, after: string>"
#: A group's key; null comes first, then others by their UTF-8 bytes.
GROUP = "group_key"
PLACE_BITS = 33


def group_key(group: Column) -> Column:
    return F.coalesce(F.concat(F.lit("0"), group.cast("string")), F.lit(""))


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Hex sha256 of the values of a row, each written so that no two rows are written alike."""
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased; only a text with other letters is looked at letter by letter."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, A_Z, LOWER))


def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``place`` within GROUP, from 0 in ``order``, and ``n``, the rows of the group.

    Rows are range-partitioned by group and order and stored with their number in the partition;
    counts per partition and group, of which there are about as many as partitions and groups
    together, give every part its offset.
    """
    keys = [GROUP, *order]
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    held = stored(sorted_.withColumn("id", F.monotonically_increasing_id()), name).withColumn("part", F.shiftright("id", PLACE_BITS))
    parts = held.groupBy(GROUP, "part").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
    # One row per group and partition that it spans.
    of_group = Window.partitionBy(GROUP)
    upto = F.sum("rows").over(of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    offsets = parts.select(GROUP, "part", (upto - F.col("rows") - F.col("first")).alias("shift"), F.sum("rows").over(of_group).alias("n"))
    return lookup(held, offsets, [GROUP, "part"]).withColumn("place", F.col("id") + F.col("shift")).drop("id", "part", "shift")


def _slots(fanout: int) -> list[str]:
    return [f"slot_{j}" for j in range(fanout)]


def _pivot(nodes: DataFrame, child: Column, fanout: int) -> DataFrame:
    """A row per parent: GROUP, place, n (children of the group), children by slot, and ``digest``.

    ``child`` is a struct whose first field is the digest. The only node of a group is passed on.
    """
    slot = F.pmod("place", F.lit(fanout))
    spread = [F.max(F.when(slot == j, child)).alias(c) for j, c in enumerate(_slots(fanout))]
    rows = nodes.groupBy(GROUP, F.floor(F.col("place") / fanout).alias("place"), "n").agg(*spread)
    whole = F.sha2(F.concat_ws("", *(F.col(f"{c}.digest") for c in _slots(fanout))), 256)
    return rows.withColumn("digest", F.when(F.col("n") == 1, F.col("slot_0.digest")).otherwise(whole))


def _step(fanout: int, j: int) -> Column:
    """The siblings of the child in slot ``j``: all columns but its own."""
    names = [F.col(f"{c}.digest") for c in _slots(fanout)]
    return F.struct(F.concat_ws("", F.lit(""), *names[:j]).alias("before"), F.concat_ws("", F.lit(""), *names[j + 1:]).alias("after"))


def _levels(first: DataFrame, fanout: int, name: str) -> list[DataFrame]:
    """Levels of parents over the level ``first``, up to where every group has one node left.

    In each level ``left`` is the number of the group's nodes in that level.
    """
    def level(pivot: DataFrame) -> DataFrame:
        return stored(pivot.withColumn("left", F.ceil(F.col("n") / fanout).cast("long")), name)

    levels = [level(first)]
    while (levels[-1].agg(F.max("left")).first()[0] or 1) > 1:
        nodes = levels[-1].where("left > 1").select(GROUP, "place", F.col("left").alias("n"), "digest")
        levels.append(level(_pivot(nodes, F.struct("digest"), fanout)))
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    tops = [x.where("left = 1").select(GROUP, "digest") for x in levels]
    whole = tops[0]
    for x in tops[1:]:
        whole = whole.unionByName(x)
    return whole


def _with_paths(levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """The lowest level with the columns of ``tops`` and with ``path``, the steps from each of its nodes upwards.

    ``tops`` has GROUP, path and what else every node of a group shall have.
    """
    shared = [c for c in tops.columns if c not in (GROUP, "path")]
    above = None
    for level in reversed(levels):
        own = level.where("left = 1").join(tops, GROUP)
        if above is not None:
            up = above.withColumnsRenamed({"place": "parent", **{c: f"up_{c}" for c in _slots(fanout)}}).drop("n", "left", "digest")
            children = level.where("left > 1").withColumn("parent", F.floor(F.col("place") / fanout))
            slot = F.pmod("place", F.lit(fanout))
            digests = [F.col(f"up_{c}.digest") for c in _slots(fanout)]
            before = F.concat_ws("", F.lit(""), *(F.when(slot > j, d) for j, d in enumerate(digests)))
            after = F.concat_ws("", F.lit(""), *(F.when(slot < j, d) for j, d in enumerate(digests)))
            step = F.array(F.struct(before.alias("before"), after.alias("after")))
            joined = children.join(up, [GROUP, "parent"]).withColumn("path", F.concat(step, F.col("path")))
            own = own.unionByName(joined.select(*own.columns))
        above = own
    return above.select(*levels[0].columns, *shared, "path")


def manifest(leaves: DataFrame, fanout: int = FANOUT, order: str = "doc_id") -> DataFrame:
    """Every row of ``leaves`` with subroot, root and path.

    ``leaves`` has GROUP (see ``group_key``), ``order`` and digest, and any other columns but place,
    n, part, id, shift, left, subroot, root and path. Leaves of a group ascend by ``order``, null
    first, equal ones by digest; while several nodes are left, every ``fanout`` of them become their
    hash, also a last one by itself. What is left is the subroot; subroots in order of their groups
    make the root in the same way. ``path`` is an array of STEPs, from the leaf to the root. An empty
    table has no root, and gives no rows.
    """
    rows = _numbered(stored(leaves, "hashed"), [order, "digest"], "leaves")
    child = F.struct("digest", *(c for c in leaves.columns if c not in (GROUP, "digest")))
    levels = _levels(_pivot(rows, child, fanout), fanout, "nodes")
    roots = _numbered(_tops(levels).withColumnRenamed(GROUP, "of").withColumn(GROUP, F.lit("")), ["of"], "subroots")
    top = _levels(_pivot(roots, F.struct("digest", "of"), fanout), fanout, "top")
    root = _tops(top).first()
    last = top[0].sparkSession.createDataFrame(
        [("", [], root["digest"] if root else None)], f"{GROUP} string, path array<{STEP}>, root string")
    subroots = _children(_with_paths(top, F.broadcast(last), fanout), fanout)
    subroots = subroots.select(F.col("of").alias(GROUP), F.col("digest").alias("subroot"), "root", "path")
    found = _children(_with_paths(levels, subroots, fanout), fanout)
    return found.select(*leaves.columns, "subroot", "root", "path")


def _children(level: DataFrame, fanout: int) -> DataFrame:
    """The children of a lowest level, each with its own path."""
    own = F.array(*(F.struct(F.col(c).alias("child"), _step(fanout, j).alias("step")) for j, c in enumerate(_slots(fanout))))
    kept = [c for c in level.columns if c not in _slots(fanout) and c not in ("digest", "place", "left")]
    rows = level.select(*kept, F.explode(F.filter(own, lambda x: x.child.isNotNull())).alias("leaf"))
    path = F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(F.array("leaf.step"), F.col("path")))
    return rows.select(*(c for c in kept if c not in ("path", "n")), "leaf.child.*", path.alias("path"))


def proof_hash(path: Column) -> Column:
    """Hex sha256 of all siblings of a path, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s.before, s.after)), ""), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and the siblings on its path lead to."""
    return F.aggregate(path, digest, lambda d, s: F.sha2(F.concat(s.before, d, s.after), 256))
