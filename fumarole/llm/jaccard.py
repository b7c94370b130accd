"""Exact near-duplicate classes by Jaccard similarity of word shingles, over parity sketches.

A set of shingle hashes is cut into k ranges of the hash space and each range is XORed into one
64-bit sketch. A shingle that only one of two sets holds changes one range. Two sets whose
symmetric difference is at most d therefore agree in one of k > d ranges: that is the join key.
d depends on the sizes, so sets are joined per size band: sets of band g meet those of band g
and of band g - 1, under the d of the largest size of g. An empty range proves nothing; a set
with no more than d filled ranges is cut again with other hashes, and a pair that met in empty
ranges only is such a pair on both sides, so no pair is lost.

Sets that share a sketch are compared without listing the pairs of a group. Each bucket first
compares its members with one centre; links join classes; what a bucket still holds of different
classes is then compared pair by pair. Before any set is fetched, the Hamming distance of two
2,048-bit parity sketches, which is never above the symmetric difference, must be within d.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fumarole.llm.common import GOLDEN, bound_batches, fresh, mix, signed, small_batches, stored, window_hashes, word_hashes

PARITY_BITS = 2048
#: How often a set with too few filled ranges is cut anew before empty ranges count as well.
CUTS = 8
NODE = ["d1", "d2"]


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, one without words none."""
    hashes = word_hashes((text or "").encode().lower().split())
    width = min(width, len(hashes))
    return np.unique(window_hashes(hashes, width, width)) if width else np.empty(0, np.uint64)


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    whole = xxhash.xxh3_128_intdigest(shingles.tobytes())
    sign = 1 << 63
    return (whole >> 64) - sign, (whole & (2 * sign - 1)) - sign


def difference_bound(sizes: int, num: int, den: int) -> int:
    """Largest symmetric difference of two linked sets whose sizes sum up to ``sizes``."""
    return sizes * (den - num) // (den + num)


@lru_cache(maxsize=None)
def band_starts(num: int, den: int) -> np.ndarray:
    """First sizes of the bands: linked sets lie in the same band or in neighbours."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(starts[-1] * den // num + 1)
    return np.array(starts)


@lru_cache(maxsize=None)
def band_cut(group: int, num: int, den: int) -> tuple[int, int]:
    """(d, k) of a band: differences to survive, and ranges to cut a set into."""
    starts = band_starts(num, den)
    d = difference_bound(2 * (int(starts[group + 1]) - 1), num, den)
    least = int(starts[max(group - 1, 0)])
    spare = 1.5 * (d + 1) * np.exp(-least / (d + 1))  # about so many ranges stay empty
    return d, d + 2 + int(spare)


def sketch_keys(shingles: np.ndarray, group: int, num: int, den: int) -> np.ndarray:
    d, k = band_cut(group, num, den)
    keys, cut = [], shingles
    bounds = np.arange(k, dtype=np.uint64) * np.uint64((1 << 64) // k)
    for again in range(CUTS):
        if again:
            cut = np.sort(mix(cut + GOLDEN))
        starts = np.searchsorted(cut, bounds)
        filled = np.flatnonzero(np.diff(np.append(starts, len(cut))))
        parity = np.zeros(k, np.uint64)
        parity[filled] = np.bitwise_xor.reduceat(mix(cut ^ GOLDEN), starts[filled])
        enough = len(filled) > d
        use = filled if enough or again < CUTS - 1 else np.arange(k)
        tag = np.uint64((group * CUTS + again) << 40) + use.astype(np.uint64)
        keys.append(mix(parity[use] * GOLDEN + mix(tag)))
        if enough:
            break
    return np.concatenate(keys)


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """PARITY_BITS bits as 64-bit integers: each tells whether an odd number of hashes fell on it."""
    at = (mix(shingles) >> np.uint64(32)) % np.uint64(PARITY_BITS)
    odd = np.bincount(at.astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _document_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            n, high, low = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, width)
                a, b = digest(s)
                n.append(len(s)), high.append(a), low.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), *(pa.array(x, pa.int64()) for x in (n, high, low))],
                names=["doc_id", "text_hash", "n_shingles", *NODE])
    return run


def _key_rows(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = band_starts(num, den)
        for batch in small_batches(batches):
            seen, keys, high, low, upper = set(), [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, width)
                name = digest(s)
                if not len(s) or name in seen:  # a copy has the keys of the first
                    continue
                seen.add(name)
                own = int(np.searchsorted(starts, len(s), "right")) - 1
                for group in (own, own + 1):
                    if band_cut(group, num, den)[0]:  # else only equal sets are linked
                        k = sketch_keys(s, group, num, den)
                        keys.append(k)
                        high.append(np.full(len(k), name[0])), low.append(np.full(len(k), name[1]))
                        upper.append(np.full(len(k), group == own))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate(keys))), pa.array(np.concatenate(high)), pa.array(np.concatenate(low)),
                     pa.array(np.concatenate(upper))], names=["key", *NODE, "upper"])
    return run


def _set_rows(width: int):
    """Sets and parity sketches of the wanted classes; a row with another text is passed over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = []
            for text, a, b in zip(*(batch.column(c).to_pylist() for c in ("text", *NODE))):
                s = shingle_set(text, width)
                if digest(s) == (a, b):
                    rows.append((a, b, len(s), parity_sketch(s).tolist(), s.tobytes()))
            if rows:
                a, b, n, sketch, sets = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64()),
                     pa.array(sketch, pa.list_(pa.int64())), pa.array(sets, pa.binary())],
                    names=[*NODE, "n", "sketch", "hashes"])
    return run


def _linked_rows(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "hashes"):
            keep = []
            for a, b in zip(batch.column("hashes").to_pylist(), batch.column("hashes_2").to_pylist()):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(den * shared >= num * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _name(d1: str = "d1", d2: str = "d2") -> Column:
    return F.concat(F.hex(d1).cast("string"), F.lit("-"), F.hex(d2).cast("string"))


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the least node it reaches.

    ``known`` labels of earlier links are kept up: only links between their classes are followed.
    Each round takes the least label among the neighbours, then the label's own label; rounds
    grow with the logarithm of the longest chain.
    """
    if known is not None:
        a, b = (known.select(F.col("node").alias(c), F.col("label").alias(f"{c}_class")) for c in "ab")
        links = (links.join(a, "a", "left").join(b, "b", "left")
                 .select(F.coalesce("a_class", "a").alias("a"), F.coalesce("b_class", "b").alias("b")).where("a <> b"))
    edges = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    if known is not None and edges.isEmpty():
        return known
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = (edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near")))
        step = stored(labels.join(near, F.col("node") == F.col("a"))
                      .select("node", F.least("label", "near").alias("to"), F.col("label").alias("before")), "step")
        jump = step.select(F.col("node").alias("to"), F.col("to").alias("further"))
        new = stored(step.join(jump, "to").select("node", F.least("to", "further").alias("label"),
                                                  (F.least("to", "further") != F.col("before")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            break
    if known is None:
        return labels
    # The nodes here are classes of ``known`` or nodes it has not seen.
    onward = labels.select(F.col("node").alias("label"), F.col("label").alias("to"))
    before = known.join(onward, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return stored(before.unionByName(labels.join(known.select("node"), "node", "left_anti")), "labels")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """(node, n, sketch, hashes) of rows with a text and the class it is to have."""
    return (texts.mapInArrow(_set_rows(width), "d1 long, d2 long, n long, sketch array<long>, hashes binary")
            .select(_name().alias("node"), "n", "sketch", "hashes"))


def near_duplicates(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_hash, n_shingles, component_id.

    Two texts are linked when ``den * shared >= num * union`` of their sets of ``width`` lower-cased
    words, for ``similarity`` = (num, den). component_id is the smallest doc_id reachable by links.
    Exact: sets are compared as 64-bit hashes within a pair and named by 128 bits. Null or empty
    texts and texts without words have no shingles and link with nothing. Rows with equal texts get
    equal results; rows that share a doc_id count one by one, as the texts they have. A row without
    doc_id links as others do but lends no id; alone or among such rows its component_id is null.
    """
    num, den = similarity
    if not 2 * num > den >= num > 0:
        raise ValueError("the similarity has to be above a half, and 1 at most")
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    node_type = "d1 long, d2 long"
    rows = stored(docs.mapInArrow(_document_rows(width), f"doc_id {dict(docs.dtypes)['doc_id']}, text_hash long, n_shingles long, {node_type}"), "sets")
    # One row stands for a class when its text is fetched again, one with a doc_id if there is any.
    stands = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("stands")
    classes = rows.where("n_shingles > 0").groupBy(*NODE).agg(F.min("doc_id").alias("first"), stands)

    keys = docs.mapInArrow(_key_rows(width, num, den), f"key long, {node_type}, upper boolean")
    same = Window.partitionBy("key")
    buckets = stored(
        keys.withColumns({"lo": F.min("d1").over(same), "hi": F.max("d1").over(same)}).where("lo <> hi")
        .select("key", *NODE, "upper").distinct(), "buckets")
    wanted = buckets.select(*NODE).distinct().join(classes, NODE).select(
        *NODE, F.col("stands.doc_id").alias("id"), F.col("stands.text_hash").alias("hash"))
    same_text = F.col("text_hash") == F.col("hash")
    named = docs.join(wanted.where("id is not null"), (F.col("doc_id") == F.col("id")) & same_text)
    nameless = docs.where("doc_id is null").join(wanted.where("id is null"), same_text)  # each of its copies
    sets = stored(
        _sets(named, width).unionByName(_sets(nameless, width).dropDuplicates(["node"])), "candidates")
    buckets = stored(buckets.select("key", _name().alias("node"), "upper"), "members")

    labels = _classes(buckets, sets, num, den)
    names = classes.select(_name().alias("node"), *NODE, "first")
    whole = (names.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    least = whole.groupBy("label").agg(F.min("first").alias("component_id"))
    of_class = whole.join(least, "label", "left").select(*NODE, "component_id")
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(32))
    copies = of_class.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(31)).cast("array<long>")))
    return (rows.withColumn("salt", spread).join(copies, [*NODE, "salt"], "left")
            .select("doc_id", "text_hash", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows of ``docs`` without those that a smaller doc_id of their component stands for.

    Of the texts under the smallest doc_id one stays, and of repeated rows one. Rows without
    doc_id stay.
    """
    found = near_duplicates(docs, width, similarity).where("doc_id = component_id")
    ids, hashes = fresh(docs, "kept_id"), fresh(docs, "kept_hash")
    # A text without shingles is its own component, beside others under its doc_id.
    kept = (found.groupBy("doc_id", F.when(F.col("n_shingles") == 0, F.col("text_hash")).alias("alone"))
            .agg(F.min("text_hash").alias(hashes)).select(F.col("doc_id").alias(ids), hashes))
    named = docs.where("doc_id is not null").withColumn(hashes, F.xxhash64("text"))
    stay = (named.join(kept.withColumnRenamed(hashes, f"{hashes}_2"), (F.col("doc_id") == F.col(ids)) & (F.col(hashes) == F.col(f"{hashes}_2")))
            .dropDuplicates(["doc_id", hashes]))
    return stay.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def _classes(buckets: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(node, label) of all linked sets: stars of links first, then the rest between their classes."""
    sketches = sets.select("node", "n", "sketch")
    distance = F.aggregate(F.zip_with("sketch", "sketch_2", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    near = distance * (den + num) <= (F.col("n") + F.col("n_2")) * (den - num)

    def second(df: DataFrame) -> DataFrame:
        return df.select(*(F.col(c).alias(f"{c}_2") for c in df.columns))

    def verified(pairs: DataFrame, round_: str) -> DataFrame:
        """Of (a, b), what is linked indeed."""
        close = (pairs.distinct().join(sketches, F.col("a") == F.col("node")).drop("node")
                 .join(second(sketches), F.col("b") == F.col("node_2")).where(near).select("a", "b"))
        side = sets.select("node", "hashes")
        whole = (stored(close, f"close-{round_}").join(side, F.col("a") == F.col("node")).drop("node")
                 .join(second(side), F.col("b") == F.col("node_2")))
        return stored(whole.select("a", "b", "hashes", "hashes_2")
                      .mapInArrow(_linked_rows(num, den), "a string, b string").distinct(), f"links-{round_}")

    labels, open_ = None, buckets.withColumn("label", F.col("node"))
    for star in (0, 1):
        # A bucket's centre differs from round to round; sets of one class need no more links.
        centre = F.min(F.struct(F.xxhash64("label", F.lit(star)), "node", "label", "upper")).over(Window.partitionBy("key"))
        pairs = (open_.withColumn("centre", centre)
                 .where("label <> centre.label and (upper or centre.upper)")
                 .select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b")))
        labels = components(verified(pairs, f"star{star}"), labels)
        same = Window.partitionBy("key")
        open_ = stored(
            buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            .withColumns({"lo": F.min("label").over(same), "hi": F.max("label").over(same)})
            .where("lo <> hi").drop("lo", "hi"), "open")
        if open_.isEmpty():
            return labels
    left = open_.join(sketches, "node")
    rest = (left.join(second(left), F.col("key") == F.col("key_2"))
            .where((F.col("node") < F.col("node_2")) & (F.col("label") != F.col("label_2")) & (F.col("upper") | F.col("upper_2")) & near)
            .select(F.col("node").alias("a"), F.col("node_2").alias("b")))
    return components(verified(rest, "rest"), labels)
