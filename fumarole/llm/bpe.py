"""Byte-level BPE with the tiktoken library and a rank file: ids of whole texts, and back.

The rank file is read once, by the driver, and goes to the tasks as a broadcast of its bytes,
which are limited to MAX_RANK_BYTES; each Python worker builds the encoder once.
"""

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from fumarole.llm.common import bound_batches, small_batches

MAX_RANK_BYTES = 64 << 20
#: Longer texts go through the encoder in pieces of about so many characters.
PIECE_CHARS = 1 << 16
#: White space of the pattern's ``\s``, in runs that its backtracking had better not go through.
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % (1 << 14))


@lru_cache(maxsize=4)
def encoder(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """Encoder of the lines ``base64 rank`` of a rank file, without special tokens."""
    pairs = (line.split() for line in ranks.splitlines() if line.strip())
    return tiktoken.Encoding(
        hashlib.sha256(ranks).hexdigest(), pat_str=pattern,
        mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs}, special_tokens={})


def broadcast_ranks(spark: SparkSession, path: str) -> Broadcast:
    with open(path, "rb") as f:
        ranks = f.read(MAX_RANK_BYTES + 1)
    if len(ranks) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    return spark.sparkContext.broadcast(ranks)


def pieces(text: str, chars: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in parts that are encoded alone as they are inside it.

    A cut is made before a blank that follows a letter or digit: no match of the pattern goes on
    from a letter or digit into white space, and none looks back. A text without such a place
    stays whole, however long.
    """
    start = 0
    while len(text) - start > chars:
        at = text.find(" ", start + chars)
        while at > 0 and not text[at - 1].isalnum():
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def matches(text: str) -> Iterator[tuple[str, bool]]:
    """``text`` in parts, and whether a part is one match of the pattern: a long run of white space.

    A run of white space starts a match. At the end of the text that is all of it; before anything
    else the last character is left to the next match.
    """
    start = 0
    for run in LONG_BLANKS.finditer(text):
        end = run.end() - (run.end() < len(text))
        yield text[start:run.start()], False
        yield text[run.start():end], True
        start = end
    yield text[start:], False


@lru_cache(maxsize=4)
def whole_encoder(enc: tiktoken.Encoding) -> tiktoken.Encoding:
    """The same ranks, with any text as one match."""
    return tiktoken.Encoding(f"{enc.name} whole", pat_str="(?s:.+)", mergeable_ranks=enc._mergeable_ranks, special_tokens={})


def encode(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    if len(text) <= PIECE_CHARS:
        return np.array(enc.encode_ordinary(text), np.uint32)
    parts = ([whole_encoder(enc).encode_ordinary(part)] if one else map(enc.encode_ordinary, pieces(part)) for part, one in matches(text))
    return np.concatenate([np.array(ids, np.uint32) for part in parts for ids in part])


def encode_texts(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: its id and ``ids``, little-endian 32-bit integers as binary.

    Null and empty texts have no ids (empty binary, not null). Other columns are not read; repeated
    rows are encoded each for itself. Texts are taken whole.
    """
    bound_batches(df.sparkSession)
    ranks = broadcast_ranks(df.sparkSession, rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks.value, pattern)
        for batch in small_batches(batches, text_col):
            ids = [encode(enc, t).astype("<u4").tobytes() if t else b"" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def decode_ids(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """The bytes of each row's ``ids`` beside them, as ``decoded``; not checked to be UTF-8.

    Null ids decode to no bytes. An id that the rank file lacks fails the job.
    """
    ranks = broadcast_ranks(df.sparkSession, rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks.value, pattern)
        for batch in small_batches(batches, "ids"):
            raw = [enc.decode_bytes(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[id_col, "ids", "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, ids binary, decoded binary")
