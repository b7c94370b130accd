"""Language of a text by cross-parsing: how few pieces of a language's own text it is made of.

For every language a suffix automaton of a bounded sample of labelled text is built. A text is
parsed greedily into the longest pieces that occur in that sample; the phrases of the parsing
estimate the text's cross-entropy under the language. A phrase costs the same in all languages, log2
of the longest sample's length in bits: a language of which little was learned has short pieces and
more phrases, and cannot make up for that by cheaper ones. The language with the fewest bits wins.
Letters count, case and all other characters do not: a run of other characters is one blank.

Every letter of the samples is a symbol of its own, whatever the number of letters and scripts;
only letters that no sample holds are alike, and end a phrase. A language tells apart the letters
of its own sample. A task lays its texts out as rows of CHUNK symbols, where a phrase ends in every
language alike, and takes one symbol of all rows at a time through the automaton's transitions, so the parsing is a few array operations per
symbol. Transitions are a table of states by letters, or a hash table where that would be large.
"""

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fumarole.llm.common import GOLDEN, small_batches

#: Labelled text per language that is learned, in characters: the stated bound of the sample.
SAMPLE_CHARS = 40_000
#: Automata that a Python worker holds: each some 8 MB, whatever the number of letters.
MAX_LANGUAGES = 100
#: How much wider a share of hashes is drawn where a smaller one held too few characters.
WIDER = 16
#: Cells of all tables of states by letters together; a larger automaton is a hash table.
DENSE_CELLS = 1 << 26
CHUNK = 256
ROWS_AT_ONCE = 1 << 14
PIECE_CHARS = CHUNK << 12
#: A bit of difference is weaker evidence in a score than a bit of independent draws.
SCORE_WEIGHT = 1 / 16
OTHER, BLANK = 0, 1
UNKNOWN = "und"


def learn(docs: DataFrame, sample_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Sample text by language from ``docs`` (text, lang), at most ``sample_chars`` each.

    The texts with the smallest hashes are taken until their characters suffice or there are no
    more, so the sample does not depend on layout and copies are taken once; languages and texts
    that are null are left out. A text longer than what is missing is cut. The driver holds
    MAX_LANGUAGES * sample_chars characters at most.
    """
    texts = docs.where("lang is not null and length(text) > 0").select(
        "lang", F.substring("text", 1, sample_chars).alias("text"), F.xxhash64("text").alias("place"))
    sums = texts.groupBy("lang").agg(F.sum(F.length("text")).alias("chars")).limit(MAX_LANGUAGES + 1).collect()
    if len(sums) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # Four times the characters that are wanted, by hash, before anything is sorted. Where copies make up
    # most of a language that is too few, and the language is drawn again with a wider share.
    shares = {r["lang"]: 4 * sample_chars / r["chars"] for r in sums}
    found: dict[str, list[str]] = {}
    while shares:
        found |= (drawn := _drawn(texts, shares, sample_chars))
        shares = {lang: WIDER * share for lang, share in shares.items()
                  if share < 1 and sum(map(len, drawn.get(lang, ()))) < sample_chars}
    return {lang: "\n".join(parts) for lang, parts in found.items()}


def _drawn(texts: DataFrame, shares: dict[str, float], sample_chars: int) -> dict[str, list[str]]:
    """Different texts of the languages in ``shares``, by hash, out of that share of all hashes."""
    share = F.element_at(F.create_map(*(F.lit(x) for lang, part in shares.items() for x in (lang, part if part < 1 else 2.0))), F.col("lang"))
    few = (texts.where(F.col("lang").isin(list(shares)) & ((F.col("place") / F.lit(2.0 ** 64) + 0.5) < share))
           .dropDuplicates(["lang", "place"]))
    before = F.sum(F.length("text")).over(Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)) - F.length("text")
    rows = few.withColumn("before", before).where(F.col("before") < sample_chars).select(
        "lang", "place", F.substring("text", F.lit(1), F.lit(sample_chars) - F.col("before").cast("int")).alias("text")).collect()
    found: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["place"])):
        found.setdefault(r["lang"], []).append(r["text"])
    return found


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions by state; state 0 has read nothing, and every path spells a factor."""
    steps: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for c in symbols:
        new = len(steps)
        steps.append({}), length.append(length[last] + 1), link.append(0)
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = new
            p = link[p]
        if p >= 0:
            q = steps[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(steps)
                steps.append(dict(steps[q])), length.append(length[p] + 1), link.append(link[q])
                link[q] = link[new] = clone
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = clone
                    p = link[p]
        last = new
    return steps


class Dense:
    """An automaton as a table of the next step.

    ``table[state * width + symbol]`` is twice the next state's row, plus one where a phrase ends
    before the symbol. The last symbol fills short rows and changes nothing.
    """

    def __init__(self, steps: list[dict[int, int]], width: int):
        table = np.full((len(steps), width), -1, np.int64)
        for state, to in enumerate(steps):
            table[state, list(to)] = list(to.values())
        start = np.maximum(table[0], 0)
        ends = table < 0
        table = np.where(ends, start, table) * width * 2 + ends
        table[:, -1] = np.arange(len(steps)) * width * 2
        self.table = table.astype(np.int32 if table.max() < 2**31 else np.int64).ravel()

    def phrases(self, columns: np.ndarray) -> np.ndarray:
        state = np.zeros(columns.shape[1], self.table.dtype)
        count = np.ones(columns.shape[1], np.int32)
        for symbols in columns:
            step = self.table.take(state + symbols)
            count += (step & 1).astype(np.int32)
            state = step >> 1
        return count


class Sparse:
    """The same automaton as a hash table of its transitions, whose size the letters do not add to.

    The key ``state * width + symbol`` stands at its hash or, if that is taken, in the next free slot.
    """

    EMPTY = np.uint64(2**64 - 1)

    def __init__(self, steps: list[dict[int, int]], width: int):
        self.width, self.fill = np.uint64(width), width - 1
        self.start = np.zeros(width, np.uint64)
        self.start[list(steps[0])] = list(steps[0].values())
        keys = np.array([state * width + c for state, to in enumerate(steps) for c in to], np.uint64)
        values = np.array([x for to in steps for x in to.values()], np.uint64)
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys, self.values = np.full(1 << bits, self.EMPTY), np.zeros(1 << bits, np.uint64)
        slots = self.slots(keys)
        while len(keys):
            free = self.keys[slots] == self.EMPTY
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + np.uint64(1)) & self.last

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * GOLDEN) >> self.shift

    def phrases(self, columns: np.ndarray) -> np.ndarray:
        state = np.zeros(columns.shape[1], np.uint64)
        count = np.ones(columns.shape[1], np.int32)
        for symbols in columns:
            keys = state * self.width + symbols
            slots = self.slots(keys)
            found = self.keys.take(slots)
            on = np.flatnonzero((found != keys) & (found != self.EMPTY))
            while len(on):
                slots[on] = (slots[on] + np.uint64(1)) & self.last
                found[on] = self.keys.take(slots[on])
                on = on[(found[on] != keys[on]) & (found[on] != self.EMPTY)]
            known, filled = found == keys, symbols == self.fill
            count += ~known & ~filled
            state = np.where(filled, state, np.where(known, self.values.take(slots), self.start.take(symbols)))
        return count


def folded(c: str) -> str:
    """``c`` without its case; a letter whose small form is several characters stays."""
    small = c.lower()
    return small if len(small) == 1 else c


class Parser:
    """Automata of all languages over one alphabet, the letters of all samples.

    ``symbol`` is the symbol of a character, ``known[k]`` the symbol in language k of a symbol: OTHER
    for letters that its sample does not hold. The last symbol of an alphabet fills short rows.
    """

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        texts = dict(samples)
        letters = sorted({folded(c) for text in texts.values() for c in set(text) if c.isalpha()})
        numbers = {c: i for i, c in enumerate(letters, 2)}
        self.fill = len(letters) + 2
        self.symbol = np.fromiter(
            (numbers.get(folded(c), OTHER) if c.isalpha() else BLANK for c in map(chr, range(0x110000))),
            np.min_scalar_type(self.fill), 0x110000)
        self.languages = sorted(texts)
        self.known, self.automata, longest = [], [], 2
        for lang in self.languages:
            symbols = self.symbols(texts[lang])
            own = np.unique(symbols[symbols > BLANK])
            width = len(own) + 3
            known = np.zeros(self.fill + 1, np.min_scalar_type(width))
            known[BLANK], known[own], known[self.fill] = BLANK, np.arange(2, width - 1), width - 1
            steps = suffix_automaton(known[symbols].tolist())
            dense = len(steps) * width * max(8, len(texts)) <= DENSE_CELLS
            self.known.append(known)
            self.automata.append((Dense if dense else Sparse)(steps, width))
            longest = max(longest, len(symbols))
        self.bits = math.log2(longest)

    def symbols(self, text: str) -> np.ndarray:
        out = self.symbol[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        blank = out == BLANK
        return out[~(blank & np.append(False, blank[:-1]))]

    def phrases(self, rows: np.ndarray) -> np.ndarray:
        """Phrases of every row of symbols, by language; the phrase that a row ends in counts."""
        columns = np.ascontiguousarray(rows.T)
        out = np.empty((len(self.automata), len(rows)), np.int64)
        for k, automaton in enumerate(self.automata):
            out[k] = automaton.phrases(self.known[k].take(columns))
        return out


@lru_cache(maxsize=2)
def parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(samples)


def _prediction_rows(samples: tuple[tuple[str, str], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = parser(samples)
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            totals = np.zeros((len(p.languages), len(texts)), np.int64)
            letters = np.zeros(len(texts), bool)
            rows, owners, waiting = [], [], 0

            def flush() -> None:
                if rows:
                    owner = np.concatenate(owners)
                    for k, counts in enumerate(p.phrases(np.concatenate(rows))):
                        totals[k] += np.bincount(owner, counts, len(texts)).astype(np.int64)
                    rows.clear(), owners.clear()

            for i, text in enumerate(texts):
                for at in range(0, len(text or ""), PIECE_CHARS):
                    symbols = p.symbols(text[at:at + PIECE_CHARS])
                    letters[i] |= bool((symbols != BLANK).any())
                    n = -(-len(symbols) // CHUNK)
                    padded = np.full(n * CHUNK, p.fill, p.symbol.dtype)
                    padded[:len(symbols)] = symbols
                    rows.append(padded.reshape(n, CHUNK)), owners.append(np.full(n, i))
                    waiting += n
                    if waiting >= ROWS_AT_ONCE:
                        flush()
                        waiting = 0
            flush()
            best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if p.languages:
                bits = totals * p.bits
                least = bits.argmin(axis=0)
                weight = np.exp2(-(bits - bits.min(axis=0)) * SCORE_WEIGHT).sum(axis=0)
                best = [p.languages[k] if has else UNKNOWN for k, has in zip(least, letters)]
                score = np.where(letters, 1 / weight, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(best, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs`` (doc_id, text), by ``learn``'s samples.

    Whole texts are parsed. A null text, one without a letter, and any text if nothing was learned
    is ``und`` with score 0; equal bits go to the first language in order. score is the winner's
    share of 2 to the minus bits / 16 over all languages. Rows are judged one by one.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _prediction_rows(tuple(sorted(samples.items()))), f"doc_id {kind}, lang_pred string, score double")
