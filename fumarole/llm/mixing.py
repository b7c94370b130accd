"""Mixing sources to target weights by hash thresholds, without sorting a document.

A document's place is a hash of its id. A source's mix is: all its documents as often as its
target holds them whole, and once more those below a threshold. Thresholds come from histograms
over (source, leading hash bits); the bucket that the budget ends in is the only one refined, by
its next bits. Every pass is an aggregation with partial sums, so a source with a third of all
rows is as good as any other.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fumarole.llm.common import WORD, fresh, stored
from fumarole.plans.sizing import lookup

#: Bits of a place, and how many of them each level of histograms looks at.
LEVEL_BITS, LEVELS = 12, 3
PLACES = 1 << (LEVEL_BITS * LEVELS)


def place(doc_id: Column, seed: str) -> Column:
    """A document's place among PLACES; equal ids share it. A null id counts as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, LEVEL_BITS * LEVELS // 4), 16, 10).cast("long")


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null, in the order of the sources, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, limit: float) -> DataFrame:
    """(key, source_size) with ``target``, by weights in the order of the keys, repeating.

    The targets share ``share`` of all sizes. A target stops at ``limit`` times its source's size
    and the excess is shared again by weight: every target is min(weight * level, limit * size)
    for one level. One row per source; sorted whole, as the weights follow a global order.
    """
    order = Window.orderBy("key")
    weight = F.element_at(F.lit([float(w) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.select("key", "source_size", weight.alias("weight")).withColumn("most", limit * F.col("source_size"))
    fill = Window.orderBy(F.col("most") / F.col("weight"), "key")
    rising = ranked.select(
        "*", (F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
              - F.coalesce(F.sum("most").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).alias("left"),
        F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)).alias("weights_left"))
    level = F.max(F.when(F.col("most") / F.col("weight") >= F.col("left") / F.col("weights_left"), F.col("left") / F.col("weights_left"))).over(Window.partitionBy())
    # The first source with room has the highest level. None: the limits together are below the share, and every target is its limit.
    return rising.select("key", "source_size", F.least("most", F.coalesce(F.col("weight") * level, F.col("most"))).alias("target"))


def sized_rows(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, key, place and size of every row of ``docs`` (doc_id, source, text), stored."""
    return stored(docs.select("doc_id", source_key(F.col("source")).alias("key"), place(F.col("doc_id"), seed).alias("place"),
                              size_of(F.col("text")).alias("size")), "sized")


def mix_plan(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, limit: float = 3) -> DataFrame:
    """One row per source of ``sized_rows``: key, source_size, target, whole, threshold.

    A document is taken ``whole`` times, and once more if its place is below ``threshold``.
    """
    goals = targets(sized.groupBy("key").agg(F.sum("size").alias("source_size")), weights, share, limit)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = stored(
        goals.withColumn("whole", whole)
        .select("*", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"), F.lit(0).cast("long").alias("threshold")), "goals")
    for level in range(LEVELS):
        width = 1 << (LEVEL_BITS * (LEVELS - 1 - level))  # places in a bucket of this level
        inside = (F.col("place") >= F.col("threshold")) & (F.col("place") < F.col("threshold") + width * (1 << LEVEL_BITS))
        part = lookup(sized, plan.select("key", "threshold"), ["key"]).where(inside)
        counts = part.groupBy("key", "threshold", F.floor((F.col("place") - F.col("threshold")) / width).alias("bucket")).agg(F.sum("size").alias("size"))
        upto = F.sum("size").over(Window.partitionBy("key").orderBy("bucket"))
        steps = counts.withColumn("upto", upto).join(plan.select("key", "budget"), "key")
        # Buckets that the budget holds whole are spent; the next one in order is where it ends.
        ends = steps.groupBy("key").agg(
            F.max(F.when(F.col("upto") <= F.col("budget"), F.col("upto"))).alias("spent"),
            F.min(F.when(F.col("upto") > F.col("budget"), F.struct("bucket", "size"))).alias("edge"))
        plan = plan.join(ends, "key", "left")
        budget = F.col("budget") - F.coalesce("spent", F.lit(0))
        edge = F.coalesce(F.col("edge.bucket"), F.lit(1 << LEVEL_BITS))
        if level == LEVELS - 1:  # the last bucket is taken if that comes nearer
            edge = edge + F.when(F.col("edge.size") - budget < budget, 1).otherwise(0)
        plan = stored(plan.select("key", "source_size", "target", "whole", budget.alias("budget"), (F.col("threshold") + edge * width).alias("threshold")), "plan")
    # A target of whole copies leaves nothing to take once more, not even empty texts.
    more = F.when(F.col("target") > F.col("whole") * F.col("source_size"), F.col("threshold")).otherwise(0).alias("threshold")
    return plan.select("key", "source_size", "target", "whole", more)


def _copies(whole: str, threshold: str, at: Column) -> Column:
    return F.col(whole) + (at < F.col(threshold)).cast("long")


def taken_rows(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, limit: float = 3, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, copies, taken, a row for each row of ``docs``.

    Sizes are numbers of words; ``docs`` has doc_id, source and text. Null texts have size 0 and
    follow their place like all others; a null source is a source of its own, the last one; rows
    that share a doc_id share a place and are taken alike. Nothing is random: the same rows give
    the same mix in any order and layout.
    """
    sized = sized_rows(docs, seed)
    rows = lookup(sized, mix_plan(sized, weights, share, limit), ["key"])
    rows = rows.withColumn("copies", _copies("whole", "threshold", F.col("place")))
    return rows.select("doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, limit: float = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken.

    See ``taken_rows`` for what is taken.
    """
    plan = mix_plan(sized_rows(docs, seed), weights, share, limit).select("key", "whole", "threshold")
    names = {c: fresh(docs, f"mix_{c}") for c in plan.columns}
    keyed = docs.withColumn(names["key"], source_key(F.col("source")))
    joined = lookup(keyed, plan.withColumnsRenamed(names), [names["key"]])
    copies = _copies(names["whole"], names["threshold"], place(F.col("doc_id"), seed))
    column = fresh(docs, "copies")
    return (joined.withColumn(column, copies).where(F.col(column) > 0)
            .withColumn(column, F.explode(F.sequence(F.lit(1).cast("long"), F.col(column)))).select(*docs.columns))
