"""Lines that several documents hold, kept only in the first of them.

Hashes of line keys are range-partitioned and sorted by document and position inside; one pass
over each range knows a key's first document from its first row. A batch of documents sends, of
each key, only the lines of its first document there; its later ones are known to go, so that a
line of a third of all documents reaches its range once per batch. What comes back is one
compressed bitmap per document; texts are touched once more, when bitmaps are applied.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumarole.llm.common import fresh, small_batches

MIN_CHARS = 10
BLANKS = " \t\n\x0b\x0c\r"
_ROW = "h1 long, h2 long, doc_id long, text_hash long, position long, known boolean"


def line_key(line: str) -> str:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return line.strip(BLANKS).encode().lower().decode()


def _line_rows(min_chars: int):
    sign = 1 << 63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found, first = [], {}
            for doc, text, text_hash in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "text_hash"))):
                for position, line in enumerate(text.split("\n")):
                    line = line.strip(BLANKS)
                    if len(line) >= min_chars:
                        h = xxhash.xxh3_128_intdigest(line.encode().lower())
                        found.append((h, doc, text_hash, position))
                        if doc < first.get(h, doc + 1):
                            first[h] = doc
            high, low, known = [], [], []
            for h, doc, _, position in found:
                later = doc != first[h]
                if later:  # goes anyway: any range may pass it on
                    h = xxhash.xxh3_128_intdigest(f"{doc}/{position}")
                high.append((h >> 64) - sign), low.append((h & (2 * sign - 1)) - sign), known.append(later)
            if found:
                _, docs, hashes, positions = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in (high, low, docs, hashes, positions)), pa.array(known, pa.bool_())],
                    names=["h1", "h2", "doc_id", "text_hash", "position", "known"])
    return run


def _later_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that are not of the first document of their key, from rows sorted by key and document."""
    key, first = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc = (batch.column(c).to_numpy() for c in ("h1", "h2", "doc_id"))
        known = batch.column("known").to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (known[1:] != known[:-1])))
        of_run = doc[starts].copy()
        if key == (h1[0], h2[0], known[0]):
            of_run[0] = first
        firsts = np.repeat(of_run, np.diff(np.append(starts, len(doc))))
        key, first = (h1[-1], h2[-1], known[-1]), firsts[-1]
        yield batch.select(["doc_id", "text_hash", "position"]).filter(pa.array(known | (doc != firsts)))


def _bitmap_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dropped, keep = [], []
        for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("gone").to_pylist()):
            bits = np.ones(n, np.uint8)
            bits[gone or []] = 0
            dropped.append(n - int(bits.sum()))
            keep.append(zlib.compress(np.packbits(bits).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "text_hash", "n_lines")), pa.array(dropped, pa.int64()), pa.array(keep, pa.binary())],
            names=["doc_id", "text_hash", "n_lines", "n_dropped", "keep"])


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Which lines of ``docs`` (doc_id, text) stay: doc_id, text_hash, n_lines, n_dropped, keep.

    ``keep`` is zlib over one bit per \\n-line, 1 for a line that stays. A key (see ``line_key``) of
    at least ``min_chars`` code points that several doc_ids hold stays only in the smallest one,
    there with all its lines. Null and empty texts are one empty line, which stays. There is one row
    for each distinct (doc_id, text): repeated rows share it, and texts that share a doc_id count as
    one document. A row without doc_id is compared with nothing and keeps all lines.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    rows = texts.where("doc_id is not null").mapInArrow(_line_rows(min_chars), _ROW)
    gone = (rows.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", "known", "doc_id", "position")
            .mapInArrow(_later_rows, "doc_id long, text_hash long, position long")
            .groupBy("doc_id", "text_hash").agg(F.collect_list("position").alias("gone")))
    each = texts.select("doc_id", "text_hash", (F.length("text") - F.length(F.translate("text", "\n", "")) + 1).cast("long").alias("n_lines"))
    return (each.dropDuplicates(["doc_id", "text_hash"]).join(gone, ["doc_id", "text_hash"], "left")
            .mapInArrow(_bitmap_rows, "doc_id long, text_hash long, n_lines long, n_dropped long, keep binary"))


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the lines that their bitmaps keep as text, and with n_lines and n_dropped.

    A text that loses all lines is empty, and so is a null text. ``docs`` must not have columns
    of the two names.
    """
    ids, hashes, marks = (fresh(docs, c) for c in ("keep_doc_id", "keep_text_hash", "keep"))
    named = bitmaps.select(F.col("doc_id").alias(ids), F.col("text_hash").alias(hashes), "n_lines", "n_dropped", F.col("keep").alias(marks))
    texts = docs.withColumn("text", F.coalesce("text", F.lit("")))
    same = F.col("doc_id").eqNullSafe(F.col(ids)) & (F.xxhash64("text") == F.col(hashes))
    both = texts.join(named, same, "left").drop(ids, hashes)
    schema = both.drop(marks).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            for i, (gone, keep) in enumerate(zip(batch.column("n_dropped").to_pylist(), batch.column(marks).to_pylist())):
                if gone:
                    lines = texts[i].split("\n")
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
                    texts[i] = "\n".join(line for line, bit in zip(lines, bits) if bit)
            yield batch.set_column(at, "text", pa.array(texts, pa.string())).select(schema.names)

    return both.mapInArrow(run, schema)


def without_repeats(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with each text's repeated lines gone (see ``line_bitmaps``); null texts stay null."""
    texts = docs.select("doc_id", "text")
    was = fresh(docs, "was_null")
    bitmaps = line_bitmaps(texts, min_chars).where("n_dropped > 0")
    plain = docs.select("*", F.col("text").isNull().alias(was))
    hidden = {c: fresh(docs, f"kept_{c}") for c in ("n_lines", "n_dropped") if c in docs.columns}
    renamed = plain.withColumnsRenamed(hidden)
    kept = with_bitmaps(renamed, bitmaps).drop("n_lines", "n_dropped").withColumnsRenamed({v: k for k, v in hidden.items()})
    return kept.withColumn("text", F.when(~F.col(was), F.col("text"))).select(*docs.columns)
