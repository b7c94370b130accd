"""Fill-in-middle transformation over seekable compressed texts.

A text is held as independent zstandard frames of a fixed number of characters, each with the
numbers of units and characters before it. A unit is a run of ASCII letters, or any other single
character; it belongs to the frame that it starts in, so a frame may end inside a run of letters and
a text without any other character has frames as small as all others. To cut a text at a unit, only
the frame in which the unit starts is decompressed. The output is a list of such frames again:
frames that lie whole in a part are passed on as they are, what is left of cut frames is compressed
anew, every mark is a frame of its own. Digests and originals are read frame by frame.
"""

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from fumarole.llm.common import small_batches

FRAME_CHARS = 1 << 14
LEVEL = 3
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Shares in a hundred: texts left as they are, and transformed ones with the suffix first.
PLAIN_SHARE, SPM_SHARE = 10, 20
FRAMES = "n long, n_chars long, marked boolean, units_before array<long>, chars_before array<long>, frames array<binary>"


@lru_cache(maxsize=1)
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()


def compressed(text: str) -> bytes:
    return _codec()[0].compress(text.encode())


def content(frame: bytes) -> bytes:
    return _codec()[1].decompress(frame)


def unit_starts(text: str, inside: bool = False) -> np.ndarray:
    """Where units start in ``text``; ``inside`` tells that a run of letters comes before it."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = (codes | np.uint32(32)) - np.uint32(97) < np.uint32(26)
    return np.flatnonzero(~letter | ~np.append(inside, letter[:-1]))


def _letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


@dataclass(frozen=True)
class Framed:
    """A text of ``n`` units and ``n_chars`` characters in frames, see FRAMES; ``marked``: it holds one of the marks."""

    n: int
    n_chars: int
    marked: bool
    units_before: list[int]
    chars_before: list[int]
    frames: list[bytes]

    @classmethod
    def of(cls, text: str, marks: tuple[str, ...] = MARKS, frame_chars: int = FRAME_CHARS) -> "Framed":
        units, chars, frames, n = [], list(range(0, len(text), frame_chars)), [], 0
        for at in chars:
            part = text[at:at + frame_chars]
            units.append(n)
            frames.append(compressed(part))
            n += len(unit_starts(part, at > 0 and _letter(text[at - 1])))
        return cls(n, len(text), any(m in text for m in marks), units, chars, frames)

    def start_of(self, unit: int) -> int:
        """The character that ``unit`` starts at, or the end of the text behind the last one."""
        if unit >= self.n:
            return self.n_chars
        k = int(np.searchsorted(self.units_before, unit, "right")) - 1
        starts = unit_starts(text := self.text_of(k))
        here = (self.units_before[k + 1] if k + 1 < len(self.frames) else self.n) - self.units_before[k]
        if len(starts) > here:  # the first letters go on with a unit of the frame before
            starts = unit_starts(text, True)
        return self.chars_before[k] + int(starts[unit - self.units_before[k]])

    def text_of(self, k: int) -> str:
        return content(self.frames[k]).decode()

    def part(self, start: int, end: int) -> Iterator[bytes]:
        """Frames of the characters from ``start`` to ``end``."""
        k = max(0, int(np.searchsorted(self.chars_before, start, "right")) - 1)
        while start < end:
            first, last = self.chars_before[k], self.chars_before[k + 1] if k + 1 < len(self.frames) else self.n_chars
            if start == first and end >= last:
                yield self.frames[k]
            else:
                yield compressed(self.text_of(k)[start - first:end - first])
            start, k = last, k + 1


def draws(doc_id: object, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers by seed and decimal id; a null id counts as an empty one."""
    name = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(name[i:i + 4]) for i in (0, 4, 8, 12))


def arranged(text: Framed, doc_id: object, seed: int) -> tuple[str, int | None, int | None, list[bytes]]:
    """Form, characters of prefix and middle, and frames of the output."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text.n or text.marked or h3 % 100 >= 100 - PLAIN_SHARE:
        return PLAIN, None, None, text.frames
    a, b = (text.start_of(u) for u in sorted((h1 % (text.n + 1), h2 % (text.n + 1))))
    parts = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, text.n_chars)}
    form, order = (SPM, (SUFFIX, PREFIX, MIDDLE)) if h4 % 100 < SPM_SHARE else (PSM, (PREFIX, SUFFIX, MIDDLE))
    return form, a, b - a, [f for mark in order for f in (_mark(mark), *text.part(*parts[mark]))]


@lru_cache(maxsize=None)
def _mark(mark: str) -> bytes:
    return compressed(mark)


def original(frames: list[bytes], form: str) -> Iterator[bytes]:
    """UTF-8 of the text that an output was made of, in its order, frame by frame.

    Marks are found by their size, so the parts are decompressed only as they are given out.
    """
    if form == PLAIN:
        yield from map(content, frames)
        return
    parts: dict[str, list[bytes]] = {}
    for f in frames:
        if zstandard.frame_content_size(f) == len(PREFIX) and (mark := content(f).decode()) in MARKS:
            part = parts.setdefault(mark, [])
        else:
            part.append(f)
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from map(content, parts[mark])


def sha256(parts: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for x in parts:
        digest.update(x)
    return digest.hexdigest()


def _mapped(df: DataFrame, out: str, function: Callable[..., tuple], size_by: str | None = None) -> DataFrame:
    """One row of ``out`` for each row of ``df``: ``function`` of its values."""
    schema = StructType.fromDDL(out)
    names, arrow = schema.names, to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches([batch], size_by) if size_by else _few(batch):
                rows = [function(*x) for x in zip(*(c.to_pylist() for c in part.columns))]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)

    return df.mapInArrow(run, schema)


def _few(batch: pa.RecordBatch, rows: int = 64) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def framed_texts(docs: DataFrame, frame_chars: int = FRAME_CHARS) -> DataFrame:
    """doc_id and FRAMES of every row of ``docs`` (doc_id, text), to be written once and cut by many seeds.

    A null or empty text has no frames. Other columns are not read; repeated rows stay.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def row(doc_id, text):
        f = Framed.of(text or "", MARKS, frame_chars)
        return doc_id, f.n, f.n_chars, f.marked, f.units_before, f.chars_before, f.frames

    return _mapped(docs.select("doc_id", "text"), f"doc_id {kind}, {FRAMES}", row, "text")


def fill_in_middle(framed: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output's frames, a row for each of ``framed_texts``.

    Cuts, form and order come from the seed and the id alone. Texts that are empty or hold a mark,
    and PLAIN_SHARE in a hundred of the others, stay ``plain`` and have no cuts. Rows that share an
    id are cut by the same numbers, a null id counts as an empty one.
    """
    kind = framed.schema["doc_id"].dataType.simpleString()

    def row(doc_id, *values):
        text = Framed(*values)
        return doc_id, text.n, *arranged(text, doc_id, seed)

    return _mapped(framed.select("doc_id", "n", "n_chars", "marked", "units_before", "chars_before", "frames"),
                   f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, frames array<binary>", row)


def digests(outputs: DataFrame) -> DataFrame:
    """``fill_in_middle``'s rows with output_sha256 and restored_sha256, that of ``original``, instead of frames."""
    kept = [c for c in outputs.columns if c != "frames"]
    types = dict(outputs.dtypes)
    row = lambda form, frames, *others: (*others, sha256(map(content, frames)), sha256(original(frames, form)))
    return _mapped(outputs.select("form", "frames", *kept), ", ".join(f"`{c}` {types[c]}" for c in kept) + ", output_sha256 string, restored_sha256 string", row)


def texts(outputs: DataFrame) -> DataFrame:
    """``fill_in_middle``'s rows with ``text``, the whole output, instead of frames."""
    kept = [c for c in outputs.columns if c != "frames"]
    types = dict(outputs.dtypes)
    row = lambda frames, *others: (*others, b"".join(map(content, frames)).decode())
    return _mapped(outputs.select("frames", *kept), ", ".join(f"`{c}` {types[c]}" for c in kept) + ", text string", row)
