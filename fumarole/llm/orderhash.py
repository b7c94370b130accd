"""Order MinHash fingerprints: which k-mers are smallest, and in which order the text has them.

The k-mers are runs of words, numbered by occurrence, so a repeated passage counts as often as it
stands. Each of TUPLES entries takes the smallest k-mer under each of LENGTH hash functions, puts
them in text order and hashes the tuple. A function is a hash of the numbered k-mer and the
function's key, so each orders the k-mers on its own. The share of equal entries estimates a likeness that
falls with moved, inserted and removed passages, as edit distance does, where plain MinHash would
not see an order. Spark expressions and plain aggregates only.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fumarole.llm.common import WORD, fresh

WORDS, TUPLES, LENGTH = 3, 32, 2
#: A k-mer is one 64-bit integer: 39 bits of hash above 24 bits of position.
POSITION_BITS = 24
HASH_BITS = 63 - POSITION_BITS
ENTRY_CHARS = 8


def _keys(count: int) -> list[int]:
    """Fixed 64-bit numbers, one for each hash function: a k-mer is hashed again after ^ key."""
    state, out = 0x9E3779B97F4A7C15, []
    for _ in range(count):
        state = (state * 6364136223846793005 + 1442695040888963407) & ((1 << 64) - 1)
        out.append(state - (1 << 64) if state >> 63 else state)
    return out


def fingerprints(texts: DataFrame, text: str, width: int = WORDS, tuples: int = TUPLES, length: int = LENGTH,
                 to: str = "fingerprint") -> DataFrame:
    """``texts`` without the column ``text`` and with its fingerprint; the other columns are the
    key of a row and have to tell the rows apart.

    A fingerprint is ``tuples`` entries of ENTRY_CHARS hex digits. A text of fewer than ``width``
    words is one k-mer; null, empty and blank texts have the fingerprint ''. Equal texts have
    equal fingerprints. Positions above 2^POSITION_BITS words count on from 0. Rows are grouped
    by all other columns, which costs no shuffle where ``texts`` is dealt out by some of them.
    """
    row = [c for c in texts.columns if c != text]
    words, kmers, packed, starts, run, at, size, nth, kmer, place = (
        fresh(texts, f"omh_{c}") for c in ("words", "kmers", "packed", "starts", "run", "at", "size", "nth", "kmer", "place"))
    n = F.size(words)
    above = ((1 << HASH_BITS) - 1) << POSITION_BITS
    below = (1 << POSITION_BITS) - 1
    windows = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(width))))
    hashed = (
        texts.withColumn(words, F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))).drop(text)
        .withColumn(kmers, F.when(n >= width, windows).when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>")))
        .withColumn(packed, F.sort_array(F.transform(kmers, lambda h, i: h.bitwiseAND(F.lit(above)).bitwiseOR(i.cast("long").bitwiseAND(F.lit(below))))))
        .drop(words, kmers))

    def hash_of(x: Column) -> Column:
        return F.shiftright(x, POSITION_BITS)

    first = F.filter(F.sequence(F.lit(0), F.size(packed) - 1),
                     lambda j: (j == 0) | (hash_of(F.get(packed, j)) != hash_of(F.get(packed, F.greatest(j - 1, F.lit(0))))))
    runs = (
        hashed.withColumn(starts, F.when(F.size(packed) > 0, first))
        .select(*row, packed, starts, F.posexplode_outer(starts).alias(run, at))
        .withColumn(size, F.coalesce(F.get(starts, F.col(run) + 1), F.size(packed)) - F.col(at))
        .select(*row, packed, at, F.explode_outer(F.when(F.col(at).isNotNull(), F.sequence(F.lit(0), F.col(size) - 1))).alias(nth)))
    one = F.get(packed, F.col(at) + F.col(nth))
    numbered = runs.select(*row, F.xxhash64(hash_of(one), F.col(nth)).alias(kmer), one.bitwiseAND(F.lit(below)).alias(place))

    def ordered(key: int) -> Column:
        """The k-mer's hash under a key above its position; null without a k-mer, as the position is."""
        return F.xxhash64(F.col(kmer).bitwiseXOR(F.lit(key))).bitwiseAND(F.lit(above)).bitwiseOR(F.col(place))

    least = numbered.groupBy(*row).agg(*(F.min(ordered(k)).alias(f"omh_least_{i}") for i, k in enumerate(_keys(tuples * length))))

    def entry(t: int) -> Column:
        chosen = [F.col(f"omh_least_{t * length + i}") for i in range(length)]
        if length == 2:
            a, b = chosen
            before = a.bitwiseAND(F.lit(below)) <= b.bitwiseAND(F.lit(below))
            inorder = [hash_of(F.when(before, a).otherwise(b)), hash_of(F.when(before, b).otherwise(a))]
        else:
            pairs = F.sort_array(F.array(*(F.struct(c.bitwiseAND(F.lit(below)).alias("p"), hash_of(c).alias("h")) for c in chosen)))
            inorder = [F.get(pairs, F.lit(i)).h for i in range(length)]
        return F.lpad(F.hex(F.xxhash64(*inorder).bitwiseAND(F.lit(0xFFFFFFFF))), ENTRY_CHARS, "0")

    whole = F.lower(F.concat(*(entry(t) for t in range(tuples))))
    return least.select(*row, F.when(F.col("omh_least_0").isNull(), "").otherwise(whole).alias(to))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries, 0 to 1; two empty fingerprints are alike, an empty and another not."""
    entries = F.greatest(F.length(a), F.length(b)) / ENTRY_CHARS
    same = F.size(F.filter(
        F.sequence(F.lit(0), F.greatest(entries.cast("int"), F.lit(1)) - 1),
        lambda i: F.substring(a, i * ENTRY_CHARS + 1, F.lit(ENTRY_CHARS)) == F.substring(b, i * ENTRY_CHARS + 1, F.lit(ENTRY_CHARS))))
    return F.when(entries == 0, 1.0).when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(same / entries)


def ranges(docs: DataFrame, parts: int) -> Column:
    """A bucket number by doc_id: about ``parts`` ranges of as many rows; nulls are in the first.

    The bounds are approximate quantiles, so ``parts`` numbers reach the driver.
    """
    shares = [i / parts for i in range(1, parts)]
    bounds = shares and docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * parts))).first()[0]
    if not bounds:
        return F.lit(0)
    distinct = F.lit(sorted(set(bounds)))
    return F.size(F.filter(distinct, lambda b: b <= F.coalesce("doc_id", F.lit(-(1 << 63)))))


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """bucket, row, doc_id, text, next_text, guest of ``docs`` (doc_id, text), in one shuffle.

    Rows are in the order of doc_id, null first, then text; after the last comes the first, and a
    lone row comes after itself. A bucket holds a range of doc_ids and, as guests, the rows that
    the next bucket begins with: they are nobody's result but the last row's next one.
    """
    table = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    table = table.withColumn("bucket", ranges(docs, parts))
    heads = [(r["bucket"], r["first"]) for r in table.groupBy("bucket").agg(
        F.min(F.struct("doc_id")).alias("first")).select("bucket", "first.doc_id").toDF("bucket", "first").orderBy("bucket").collect()]
    order = ["round", F.col("doc_id").asc_nulls_first(), "text"]
    # Where a bucket's first rows are guests: the bucket before it, and after all others there.
    at = [(b, first, heads[i - 1][0], int(i == 0)) for i, (b, first) in enumerate(heads)]
    hosts = docs.sparkSession.createDataFrame(at, f"bucket int, head {docs.schema['doc_id'].dataType.simpleString()}, host int, round int")
    seats = F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.array(
        F.struct(F.col("bucket"), F.lit(0).alias("round"), F.lit(False).alias("guest")),
        F.struct(F.col("host").alias("bucket"), (F.col("round") + 1).alias("round"), F.lit(True).alias("guest")))
    ).otherwise(F.array(F.struct(F.col("bucket"), F.lit(0).alias("round"), F.lit(False).alias("guest"))))
    seated = (table.join(F.broadcast(hosts), "bucket").withColumn("seat", F.explode(seats))
              .select("seat.bucket", "seat.round", "seat.guest", "doc_id", "text"))
    inside = Window.partitionBy("bucket").orderBy(*order)
    return seated.select("bucket", F.row_number().over(inside).alias("row"), "doc_id", "text",
                         F.lead("text").over(inside).alias("next_text"), "guest")


def edited_likeness(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text) and of their edited texts, with likenesses.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The
    edited text is the text with its last half replaced by as much of the start of the next one
    (see ``with_next`` for the order). Null texts are empty. A repeated row follows itself, so it
    is its own next document. ``parts`` ranges of ids are made, by default as many as the session
    has shuffle partitions; all steps keep to them, so the texts are shuffled once.
    """
    parts = parts or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    half = F.shiftright(F.length("text"), 1)
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    both = (with_next(docs, parts).withColumn("edited", edited)
            .select("bucket", "row", "doc_id", "guest", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                    F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("version"))
            .select("bucket", "row", "doc_id", "guest", "n_chars", "edited_sha256", "version.kind", "version.text")
            .where("kind = 0 or not guest"))
    prints = fingerprints(both, "text")
    row = ["bucket", "row", "doc_id", "guest", "n_chars", "edited_sha256"]
    pairs = prints.groupBy(*row).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    following = F.lead("fingerprint").over(Window.partitionBy("bucket").orderBy("row"))
    return pairs.withColumn("next_fingerprint", following).where("not guest").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
