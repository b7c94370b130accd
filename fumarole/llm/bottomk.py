"""Near-duplicate classes from bottom-k sketches of one hash function.

A document's sketch is the K least hashes of its shingle set. Of two linked sets, the K least hashes
of the union hold at least ``least_overlap`` that are in both sets, and so in both sketches: surely
while the union has no more than K elements, and else but for a chance of ERROR. By sketches of FIRST
values, classes go that share too few with any others; the rest get sketches of K values. Two sketches
that share t values share one among all but the last t - 1 values of either, in any order that is the
same for all. That order is by the number of sketches that retain a value: values of one sketch come
first and need no list, values that many documents share, as of a common passage, come last and get
into a list only for a document that is made of them.

Only classes of equal sets enter the lists. A list is never taken pair by pair at first: its members
meet one centre, each the one that it meets most often; links join classes, and lists that still hold
several classes meet another centre, but for a list of two whose members have met. What is left when
that makes no more headway is compared within its lists. A pair goes on from a list only if enough
retained values come after the list's in both orders, and if the Hamming distance of the parity
sketches of the full sets, which is never above their symmetric difference, allows a link. It counts
if the K least hashes of the union of both sketches hold enough common ones, and then if the full
sets are alike.

Sets are not sent along with every pair. Classes that met the same centre are a family, and a family
is dealt into blocks of bounded size; the pairs between two blocks are checked together, so a set
travels once for each block that its family has.
"""

from collections.abc import Iterator
from functools import lru_cache, reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fumarole.llm.common import small_batches, stored
from fumarole.llm.jaccard import PARITY_BITS, components, digest, parity_sketch, shingle_set
from fumarole.plans.sizing import small_side

#: Values that every class retains, and those of the classes that have enough of these in common with others.
FIRST, K = 32, 256
#: Chance that a link is not seen by sketches of so many values; none while all elements are retained.
ERROR = 1e-12
#: Centres that a list is tried with, at most; the first STARS rounds are made in any case.
STARS, MOST_STARS = 2, 8
#: What a block of a family holds at most, about: bytes of sets, and sets.
BLOCK_BYTES, BLOCK_NODES = 4 << 20, 512
#: A parity sketch is also folded into so many 64-bit integers, whose distance tells most pairs apart at once.
FOLDS = 8
NODE = ["d1", "d2"]


@lru_cache(maxsize=None)
def least_overlap(num: int, den: int, k: int = K) -> int:
    """So many of the k least hashes of a union are common to both sets, but for a chance of ERROR.

    Drawing without putting back strays less than a binomial, whose tail is summed here.
    """
    p, tail = num / den, 0.0
    for t in range(k + 1):
        tail += comb(k, t) * p**t * (1 - p) ** (k - t)
        if tail >= ERROR:
            return t
    return k


def needed(n: Column, num: int, den: int, k: int = K) -> Column:
    """Values that a sketch of k values, of a set of ``n``, shares with that of every set it is linked to."""
    return F.when(n * den <= k * num, F.ceil(n * num / den)).otherwise(least_overlap(num, den, k)).cast("int")


def _document_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            seen, sizes, high, low, sketches = set(), [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, width)
                name = digest(s)
                sizes.append(len(s)), high.append(name[0]), low.append(name[1])
                # A copy has the sketch of the first.
                sketches.append(s[:FIRST].view(np.int64) if len(s) and name not in seen else None)
                seen.add(name)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()),
                 pa.array(low, pa.int64()), pa.array(sketches, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", *NODE, "sketch"])
    return run


def _set_rows(width: int):
    """Sets and sketches of K values of the wanted classes; a row with another text is passed over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows, seen = [], set()
            for text, *name in zip(*(batch.column(c).to_pylist() for c in ("text", *NODE))):
                if (name := tuple(name)) not in seen and digest(s := shingle_set(text, width)) == name:
                    seen.add(name)
                    rows.append((*name, len(s), s[:K].view(np.int64), s.tobytes()))
            columns = zip(*rows) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=[*NODE, "n", "values", "hashes"])
    return run


def common(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(elements in both, elements of the union) of two sorted sets."""
    both = np.concatenate([a, b])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared, len(both) - shared


def sketches_alike(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """False if the sets of these sketches are not linked, but for a chance of ERROR."""
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    shared, union = int(np.count_nonzero(twice)), len(both) - int(np.count_nonzero(twice))
    if len(a) < K and len(b) < K:  # whole sets
        return den * shared >= num * union
    if union > K:  # the common ones among the K least of the union
        values = both[np.append(True, ~twice)]
        shared = int(np.searchsorted(both[1:][twice], values[K - 1], "right"))
    return shared >= least_overlap(num, den)


def _linked(num: int, den: int):
    """Of the pairs between two blocks, those that are linked, from the sets of both."""
    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        held = {node: np.frombuffer(x, np.uint64) for node, x in zip(sets["node"].to_pylist(), sets["hashes"].to_pylist())}
        keep = []
        for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()):
            x, y = held[a], held[b]
            linked = sketches_alike(x[:K], y[:K], num, den)
            if linked:
                shared, union = common(x, y)
                linked = den * shared >= num * union
            keep.append(linked)
        return pairs.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def with_company(classes: DataFrame, num: int, den: int) -> DataFrame:
    """The classes (d1, d2, n, sketch) that share enough of their FIRST values with others to be linked with one."""
    values = classes.select(*NODE, "n", F.explode("sketch").alias("value"))
    held = values.groupBy("value").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    shared = values.join(held, "value").groupBy(*NODE, "n").agg(F.count(F.lit(1)).alias("shared"))
    return classes.join(shared.where(F.col("shared") >= needed(F.col("n"), num, den, FIRST)).select(*NODE), NODE, "left_semi")


def list_members(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(node, n, weight, size, keys): in which lists a class is, from ``sets`` (node, n, values).

    ``size`` counts the retained values that others have too. Ordered, the rarest first, the first of
    them are the ``keys`` of its lists. ``weight`` tells how many others have these values.
    """
    values = sets.select("node", "n", F.explode("values").alias("value"))
    held = values.groupBy("value").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    # Values without another holder come before all these and take no list.
    shared = values.join(held, "value").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("holders", "value"))).alias("shared"), F.sum("holders").alias("weight"))
    lists = F.size("shared") - needed(F.col("n"), num, den) + 1
    return shared.where(lists > 0).select(
        "node", "n", "weight", F.size("shared").alias("size"), F.slice("shared.value", F.lit(1), lists).alias("keys"))


def _parity_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "hashes"):
        sketches = [parity_sketch(np.frombuffer(x, np.uint64)) for x in batch.column("hashes").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sketches, pa.list_(pa.int64()))], names=["node", "parity"])


def _open_lists(members: DataFrame) -> DataFrame:
    """The members (with label, met) of lists of several labels, with the list's ``members``.

    ``met`` tells of a member that it has met all others of its list.
    """
    lists = members.groupBy("key").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.coalesce(F.bool_or("met"), F.lit(False)).alias("done"), F.count(F.lit(1)).alias("members"))
    return stored(members.drop("met").join(lists.where("lo <> hi and not done").select("key", "members"), "key"), "open")


def _pairs_in(lists: DataFrame) -> tuple[int, int]:
    """(members, pairs) of lists, counted by their members."""
    row = lists.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("members") - 1) / 2).alias("pairs")).first()
    return row["n"], int(row["pairs"] or 0)


def _homes(sets: DataFrame, hubs: DataFrame) -> DataFrame:
    """(node, place): the block of its family that a class is in; ``hubs`` has the centre that a node met."""
    families = stored(sets.select("node", F.octet_length("hashes").alias("bytes")).join(hubs, "node", "left")
                      .select("node", "bytes", F.coalesce("hub", "node").alias("family")), "families")
    blocks = F.greatest(F.ceil(F.sum("bytes") / BLOCK_BYTES), F.ceil(F.count(F.lit(1)) / BLOCK_NODES))
    sizes = families.groupBy("family").agg(blocks.alias("blocks"))
    return stored(families.join(sizes, "family").select(
        "node", F.xxhash64("family", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("place")), "homes")


def linked_classes(nodes: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame | None:
    """(node, label) of all classes that are linked with another one; None if there is none.

    ``nodes`` are the stored ``list_members``, ``sets`` has node and hashes of all of them.
    """
    def second(df: DataFrame) -> DataFrame:
        return df.select(*(F.col(c).alias(f"{c}_2") for c in df.columns))

    def links(pairs: DataFrame) -> DataFrame:
        """Of (a, b), what is linked indeed."""
        a, b = (homes.select(F.col("node").alias(c), F.col("place").alias(f"place_{c}")) for c in "ab")
        dealt = stored(pairs.distinct().join(a, "a").join(b, "b").select(
            "a", "b", F.least("place_a", "place_b").alias("p"), F.greatest("place_a", "place_b").alias("q")), "pairs")
        asked = dealt.select(F.col("p").alias("of_p"), F.col("q").alias("of_q"), F.explode(F.array("a", "b")).alias("node")).distinct()
        here = asked.join(sets.select("node", "hashes"), "node")
        return stored(dealt.groupBy("p", "q").cogroup(here.groupBy("of_p", "of_q")).applyInArrow(_linked(num, den), "a long, b long"), "links")

    def sizes_allow(n: Column, m: Column) -> Column:
        return F.least(n, m) * den >= F.greatest(n, m) * num

    def parities_allow() -> Column:
        """That the symmetric difference of a pair (n, parity, n_2, parity_2) may be that of a link."""
        def within(distance: Column) -> Column:
            return distance * (den + num) <= (F.col("n") + F.col("n_2")) * (den - num)

        folded = sum((F.bit_count(F.col(f"f{i}").bitwiseXOR(F.col(f"f{i}_2"))) for i in range(FOLDS)), F.lit(0))
        whole = F.aggregate(F.zip_with("parity", "parity_2", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        return within(folded) & within(whole)

    sketches = nodes.select("node", "n").join(sets.select("node", "hashes").mapInArrow(_parity_rows, "node long, parity array<long>"), "node")
    folds = {f"f{i}": reduce(Column.bitwiseXOR, (F.get("parity", F.lit(j)) for j in range(i, PARITY_BITS // 64, FOLDS))) for i in range(FOLDS)}
    sketches = stored(sketches.withColumns(folds), "parities")
    members = nodes.select("node", "n", "weight", F.col("node").alias("label"), F.lit(False).alias("met"),
                           F.posexplode("keys").alias("rank", "key")).withColumn("rank", F.col("rank").cast("int"))
    lists = _open_lists(members)
    labels, before, homes = None, None, None
    for star in range(MOST_STARS):
        n, pairs = _pairs_in(lists)
        if not n:
            return labels
        if star >= STARS and (pairs <= 4 * n or 4 * pairs > 3 * before):
            break
        before = pairs
        # The first centre is the one whose values most others have, as the text that others were made of;
        # then classes take turns. Those that are joined need no more links.
        turn = F.xxhash64("label", F.lit(star)) if star else F.lit(0).cast("long")
        centre = F.min(F.struct(turn.alias("turn"), (-F.col("weight")).alias("weight"), "node", "label", "n")).alias("centre")
        centres = lists.groupBy("key").agg(centre).select("key", *(F.col(f"centre.{c}").alias(f"c_{c}") for c in ("node", "label", "n")))
        centred = lists.join(centres, "key")
        fit = sizes_allow(F.col("n"), F.col("c_n"))
        met = centred.where((F.col("label") != F.col("c_label")) & fit).groupBy("node", "c_node").agg(F.count(F.lit(1)).alias("times"))
        hubs = stored(met.groupBy("node").agg(F.max_by("c_node", F.struct("times", "c_node")).alias("hub")), "hubs")
        homes = _homes(sets, hubs) if homes is None else homes
        near = (hubs.join(sketches, "node").join(second(sketches), F.col("hub") == F.col("node_2")).where(parities_allow())
                .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")))
        labels = components(links(near), labels)
        # In a list of two, the other one may have met its hub elsewhere.
        both_met = (F.col("members") == 2) & (F.col("node") != F.col("c_node")) & (~fit | (F.col("hub") == F.col("c_node")))
        joined = (centred.drop("label").join(hubs, "node", "left").join(labels, "node", "left")
                  .select("key", "node", "n", "weight", "rank", F.coalesce("label", "node").alias("label"), both_met.alias("met")))
        lists = _open_lists(joined)
    left = (lists.select("key", "node", "label", "rank").join(nodes.select("node", "size"), "node")
            .select("key", "node", "label", (F.col("size") - F.col("rank")).alias("after")).join(sketches, "node")
            .withColumn("need", needed(F.col("n"), num, den)))
    # The first list that a linked pair shares has all its common values from there on.
    n, m = F.col("n"), F.col("n_2")
    after = F.least("after", "after_2")
    enough = (after >= F.greatest("need", "need_2")) & ((F.greatest(n, m) > K) | (after * (num + den) >= (n + m) * num))
    rest = left.join(second(left), (F.col("key") == F.col("key_2")) & (F.col("node") < F.col("node_2")) & (F.col("label") != F.col("label_2"))
                     & sizes_allow(n, m) & enough & parities_allow())
    return components(links(rest.select(F.col("node").alias("a"), F.col("node_2").alias("b"))), labels)


def near_duplicates(docs: DataFrame, width: int = 4, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Two texts are linked when ``den * shared >= num * union`` of their sets of ``width`` lower-cased
    words, for ``similarity`` = (num, den). component_id is the smallest doc_id reachable by links,
    and ``kept`` tells whether it is the row's own. Null or empty texts and texts without words have
    no shingles, link with nothing and are kept; a text of fewer words is one shingle. Rows with equal
    texts get equal results; rows that share a doc_id count one by one, as the texts they have. A row
    without doc_id links as others do but lends no id; if its component has none, component_id is
    null and the row is kept. Sets are compared as 64-bit hashes and named by 128 bits.
    """
    num, den = similarity
    if not den >= num > 0:
        raise ValueError("the similarity has to be above 0, and 1 at most")
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    rows = stored(docs.mapInArrow(
        _document_rows(width), f"doc_id {kind}, text_hash long, n_shingles long, d1 long, d2 long, sketch array<long>"), "sketches")
    # One row stands for the class when its text is fetched again.
    stands = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("stands")
    classes = stored(rows.where("n_shingles > 0").groupBy(*NODE, F.col("n_shingles").alias("n")).agg(
        F.min("doc_id").alias("first"), stands, F.max("sketch").alias("sketch")), "classes")

    wanted = with_company(classes, num, den).select(*NODE, F.col("stands.doc_id").alias("id"), F.col("stands.text_hash").alias("hash"))
    side = small_side(wanted)
    here = docs.join(wanted if side is None else side, (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id")))
    # Stored with their numbers, so that a lost executor cannot change them.
    sets = stored(here.select("text", *NODE).mapInArrow(_set_rows(width), "d1 long, d2 long, n long, values array<long>, hashes binary")
                  .dropDuplicates(NODE).withColumn("node", F.monotonically_increasing_id()), "candidates")
    labels = linked_classes(stored(list_members(sets, num, den), "members"), sets, num, den)

    of_class = classes.select(*NODE, F.col("first").alias("component_id"))
    if labels is not None:
        joined = classes.select(*NODE, "first").join(sets.select(*NODE, "node").join(labels, "node"), NODE)
        least = joined.groupBy("label").agg(F.min("first").alias("least"))
        joined = joined.join(least, "label").select(*NODE, F.lit(True).alias("joined"), "least")
        of_class = of_class.join(joined, NODE, "left").select(*NODE, F.when(F.col("joined"), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    # A class of copies may hold a third of all rows.
    copies = of_class.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(31)).cast("array<long>")))
    found = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(32))).join(copies, [*NODE, "salt"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (found.select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())))
