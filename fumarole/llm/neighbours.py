"""Quality by nearest neighbours: exact cosines to labelled documents in a latent space.

A document is a bag of terms: its words, the shapes of its words (which kinds of bytes they hold)
and words that repeat one of the words before. A bounded sample of labelled documents gives the
weights of the terms and, by singular value decomposition, the latent directions. The sample's
latent vectors and labels go to the tasks; every document is compared with all of them, block by
block, and its most similar neighbours vote by similarity.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumarole.llm.common import bound_batches, small_batches, word_hashes

#: Labelled documents that are learned: the stated bound of the sample.
SAMPLE_ROWS = 4000
WORD_TERMS, SHAPES, LAGS = 896, 128, (1, 2, 3, 4, 5, 6, 8, 10)
TERMS = WORD_TERMS + SHAPES + len(LAGS)
DIRECTIONS, NEIGHBOURS = 48, 25
#: Documents that are compared with the sample at a time: 64 kB of cosines and indices for each.
BLOCK_ROWS = 256


def _byte_kinds() -> np.ndarray:
    """One bit for each kind of byte; a word's shape is the union of its bytes' kinds."""
    kinds = np.full(256, 1 << 5, np.uint8)  # any other ASCII character
    for bit, chars in enumerate((range(97, 123), range(65, 91), range(48, 58), b".,;:'\"()-", b"!?")):
        kinds[list(chars)] = 1 << bit
    kinds[128:] = 1 << 6
    return kinds


KINDS = _byte_kinds()
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def term_counts(text: str | None) -> np.ndarray:
    """How often each of TERMS terms stands in a text; zeros for a text without words."""
    raw = (text or "").encode()
    words = raw.lower().split()
    counts = np.zeros(TERMS, np.float32)
    if not words:
        return counts
    hashes = word_hashes(words)
    counts[:WORD_TERMS] = np.bincount((hashes % np.uint64(WORD_TERMS)).astype(np.int64), minlength=WORD_TERMS)
    data = np.frombuffer(raw, np.uint8)
    blank = BLANK[data]
    starts = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    shapes = np.bitwise_or.reduceat(np.where(blank, 0, KINDS[data]), starts)
    counts[WORD_TERMS:WORD_TERMS + SHAPES] = np.bincount(shapes, minlength=SHAPES)
    for i, lag in enumerate(LAGS):
        counts[WORD_TERMS + SHAPES + i] = np.count_nonzero(hashes[lag:] == hashes[:-lag])
    return counts


@dataclass(frozen=True)
class Model:
    """What goes to the tasks: (1 + DIRECTIONS) numbers a term and (1 + DIRECTIONS) a neighbour."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_unit(np.log1p(counts) * self.weights) @ self.directions)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the neighbours, each counting by its similarity's cube."""
        k = min(NEIGHBOURS, len(self.labels))
        if not k:
            return np.full(len(counts), self.prior)
        out = np.empty(len(counts))
        for at in range(0, len(counts), BLOCK_ROWS):
            cosines = self.latent(counts[at:at + BLOCK_ROWS]) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(float) ** 3
            total = votes.sum(axis=1)
            share = (votes * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
            out[at:at + BLOCK_ROWS] = np.where(total > 0, share, self.prior)
        return np.clip(out, 0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(size > 0, size, 1)).astype(np.float32)


def fit(counts: np.ndarray, labels: np.ndarray) -> Model:
    """Latent space and neighbours from the term counts and 0/1 labels of a sample."""
    n = len(labels)
    used = (counts > 0).sum(axis=0)
    weights = np.where(used > 0, np.log((1 + n) / (1 + used)) + 0.1, 0).astype(np.float32)
    matrix = _unit(np.log1p(counts) * weights)
    _, vectors = np.linalg.eigh(matrix.T.astype(float) @ matrix) if n else (None, np.zeros((TERMS, 1)))
    directions = vectors[:, ::-1][:, :DIRECTIONS].astype(np.float32)
    return Model(weights, directions, _unit(matrix @ directions), labels.astype(float), float(labels.mean()) if n else 0.5)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model of at most ``sample_rows`` labelled rows, the same ones whatever the layout.

    ``docs`` has doc_id and text, ``labels`` doc_id and a 0/1 column ``label``. The sample is
    taken from ``labels`` by the hash of the id, so only it is joined; null ids and labels are
    left out, and labelled ids without a document lend nothing. If an id has several labels or
    texts, each pair is a row. The driver holds the sample's term counts.
    """
    bound_batches(docs.sparkSession)
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
              .select("doc_id", F.col(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows))
    held = docs.sparkSession.createDataFrame(chosen.toArrow(), chosen.schema)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = [term_counts(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], names=["doc_id", "label", "counts"])

    table = (docs.select("doc_id", "text").join(F.broadcast(held), "doc_id")
             .mapInArrow(run, f"doc_id {kind}, label int, counts binary")
             .orderBy("doc_id", "label", "counts").limit(sample_rows).toArrow())
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.float32).reshape(-1, TERMS)
    return fit(counts, table.column("label").to_numpy().astype(float))


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` (text and whatever else) with ``column``: 0 to 1, higher if label 1 is likelier.

    A text without words, null included, gets the sample's share of label 1, as does any text if
    nothing was learned (0.5 then). Scores are rounded to six places, so that the order of rows in
    a block does not show.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("*", F.lit(0.0).alias(column)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            if batch.num_rows:
                texts = batch.column("text").to_pylist()
                found = np.concatenate([
                    shared.value.score(np.array([term_counts(t) for t in texts[at:at + BLOCK_ROWS]]))
                    for at in range(0, len(texts), BLOCK_ROWS)])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.round(found, 6))], names=schema.names)

    return docs.mapInArrow(run, schema)
