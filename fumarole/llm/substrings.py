"""Passages of WINDOW words that stand earlier in the corpus, found over difference-cover anchors.

COVER is a difference cover of PERIOD: for any two positions there is a shift below PERIOD that
brings both to positions whose remainder is in COVER. An anchor is a run of ANCHOR words at such a
position, and WINDOW = ANCHOR + PERIOD - 1, so any two equal windows hold an equal anchor at the
same shift. Only 4 of 13 positions are hashed and shuffled; an anchor that stands once proves its
surroundings new. Windows around the others are hashed whole and the first one of each is found.

Before a shuffle a batch of documents keeps one row of each hash. All others it knows already: an
anchor seen twice is repeated, and a window after the first of its batch stands earlier. Those
rows go to any task, so a passage in a third of all documents costs one row per batch at its key.
Whole copies are told by a digest and take no part.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fumarole.llm.common import bound_batches, mix, signed, small_batches, stored, window_hashes, word_hashes

#: {0, 1, 3, 9} modulo 13: every remainder is a difference of two of them exactly once.
PERIOD, COVER = 13, (0, 1, 3, 9)
SECOND = np.uint64(0xD6E8FEB86659FD93)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def anchor_width(window: int) -> int:
    if window < PERIOD + 3:
        raise ValueError(f"a window has to have {PERIOD + 3} words at least")
    return window - PERIOD + 1


def _digest(words: list[bytes]) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(b" ".join(words))
    return (whole >> 64) - (1 << 63), (whole & ((1 << 64) - 1)) - (1 << 63)


def _size_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        sizes, high, low = [], [], []
        for text in batch.column("text").to_pylist():
            words = _words(text)
            a, b = _digest(words)
            sizes.append(len(words)), high.append(a), low.append(b)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), *(pa.array(x, pa.int64()) for x in (sizes, high, low))],
            names=["doc_id", "text_hash", "n_words", "d1", "d2"])


def _spread(docs: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Keys that bring rows to any task."""
    return mix(docs.view(np.uint64) * SECOND + positions.astype(np.uint64))


def _anchor_rows(window: int):
    width = anchor_width(window)
    cover = np.array(COVER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            first: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = _words(text)
                if len(words) < window:
                    continue
                name = _digest(words)
                if name in first:  # a copy: the smallest doc_id stands for all of the batch
                    first[name] = (min(doc, first[name][0]), first[name][1])
                else:
                    first[name] = (doc, window_hashes(word_hashes(words), width))
            if not first:
                continue
            hashes, docs, positions = [], [], []
            for doc, all_ in first.values():
                at = (np.arange(0, len(all_), PERIOD)[:, None] + cover).ravel()
                at = at[at < len(all_)]
                hashes.append(all_[at]), docs.append(np.full(len(at), doc)), positions.append(at)
            h, d, p = (np.concatenate(x) for x in (hashes, docs, positions))
            order = np.argsort(h, kind="stable")
            h, d, p = h[order], d[order], p[order]
            head = np.append(True, h[1:] != h[:-1])
            counts = np.diff(np.append(np.flatnonzero(head), len(h)))
            repeated = np.repeat(counts > 1, counts)
            keys = np.concatenate([h[head], _spread(d[repeated], p[repeated])])
            yield _rows([keys], np.concatenate([d[head], d[repeated]]), np.concatenate([p[head], p[repeated]]), int(head.sum()))
    return run


def _rows(keys: list[np.ndarray], docs: np.ndarray, positions: np.ndarray, unsure: int) -> pa.RecordBatch:
    """Rows of which the first ``unsure`` have a real key and the others are known already."""
    known = np.arange(len(docs)) >= unsure
    return pa.RecordBatch.from_arrays(
        [*(pa.array(signed(k)) for k in keys), pa.array(docs), pa.array(positions.astype(np.int32)), pa.array(known)],
        names=[*(f"h{i + 1}" for i in range(len(keys))), "doc_id", "position", "known"])


def _window_rows(window: int):
    width = anchor_width(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            ones, twos, docs, positions = [], [], [], []
            for doc, text, anchors in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "anchors"))):
                words = _words(text)
                n = len(words) - window + 1
                if n <= 0:
                    continue
                # A window from p on holds the anchors from p to p + window - width.
                marks = np.zeros(n + window - width, np.int32)
                anchors = np.array(anchors)
                marks[anchors[anchors < len(marks)]] = 1
                total = np.append(0, np.cumsum(marks))
                at = np.flatnonzero(total[window - width + 1:] > total[:n])
                hashes = word_hashes(words)
                ones.append(window_hashes(hashes, window)[at]), twos.append(window_hashes(hashes, window, factor=SECOND)[at])
                docs.append(np.full(len(at), doc)), positions.append(at)
            if not docs:
                continue
            a, b, d, p = (np.concatenate(x) for x in (ones, twos, docs, positions))
            order = np.lexsort((p, d, b, a))
            a, b, d, p = a[order], b[order], d[order], p[order]
            head = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            # The same document and position twice is one row given twice, not an earlier one.
            firsts = np.flatnonzero(head)[np.cumsum(head) - 1]
            later = (d != d[firsts]) | (p != p[firsts])
            spread = _spread(d[later], p[later])
            yield _rows([np.concatenate([a[head], spread]), np.concatenate([b[head], spread])],
                        np.concatenate([d[head], d[later]]), np.concatenate([p[head], p[later]]), int(head.sum()))
    return run


def _kept_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sizes, removed, kept = [], [], []
            for text, copy, starts in zip(*(batch.column(c).to_pylist() for c in ("text", "copy", "starts"))):
                words = _words(text)
                n = len(words)
                keep = np.ones(n, bool)
                if copy and n >= window:
                    keep[:] = False
                elif starts:
                    edges = np.zeros(n + 1, np.int64)
                    at = np.unique(np.array(starts))
                    at = at[at + window <= n]
                    edges[at] += 1
                    edges[at + window] -= 1
                    keep = np.cumsum(edges)[:n] == 0
                gone = n - int(keep.sum())
                sizes.append(n), removed.append(gone)
                kept.append(b" ".join(words if not gone else [w for w, k in zip(words, keep) if k]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "text"])
    return run


def _positions(rows: DataFrame, name: str) -> DataFrame:
    return stored(rows.groupBy("doc_id").agg(F.collect_list("position").alias(name)), name)


def without_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words as ``text``, a row for each row of ``docs``.

    A word goes if a window of ``window`` words over it also starts earlier: in a smaller doc_id,
    or before it in the same document. Windows are those of the given texts, not of what is left.
    Words are separated by ASCII white space and compared byte by byte; kept ones are joined by
    one blank. Null, empty and short texts have no window and lose nothing. Rows with equal doc_id
    and text get the same result and do not remove each other; other texts under one doc_id are
    versions of one document, whose windows go by their start and are removed from each version.
    Rows without doc_id are compared with nothing.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), "text").withColumn("text_hash", F.xxhash64("text"))
    named = texts.where("doc_id is not null").select("doc_id", "text")
    sizes = texts.where("doc_id is not null").mapInArrow(_size_rows, "doc_id long, text_hash long, n_words long, d1 long, d2 long")
    sizes = stored(sizes, "sizes")
    first = sizes.where(F.col("n_words") >= window).groupBy("d1", "d2").agg(F.min("doc_id").alias("first"))
    copies = stored(_with_first(sizes, first).where("doc_id > first").select("doc_id", "text_hash").distinct(), "copies")

    anchors = named.mapInArrow(_anchor_rows(window), "h1 long, doc_id long, position int, known boolean")
    twice = F.count(F.lit(1)).over(Window.partitionBy("h1", "known")) > 1
    anchors = _positions(anchors.withColumn("twice", twice).where("twice or known"), "anchors")

    around = (texts.join(anchors, "doc_id").join(copies, ["doc_id", "text_hash"], "left_anti")
              .mapInArrow(_window_rows(window), "h1 long, h2 long, doc_id long, position int, known boolean"))
    place = F.struct("doc_id", "position")
    later = place != F.min(place).over(Window.partitionBy("h1", "h2", "known"))
    starts = _positions(around.withColumn("later", later).where("later or known"), "starts")
    whole = (texts.join(starts, "doc_id", "left")
             .join(copies.withColumn("copy", F.lit(True)), ["doc_id", "text_hash"], "left"))
    return whole.mapInArrow(_kept_rows(window), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, text string")


def _with_first(sizes: DataFrame, first: DataFrame) -> DataFrame:
    """Sizes with their digest's first doc_id; a digest of many copies is spread over salts."""
    salts = 32
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(salts))
    each = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))
    return sizes.withColumn("salt", spread).join(each, ["d1", "d2", "salt"])
