import base64
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import regex

from fumarole.llm import bpe
from fumarole.llm.queries import QUERIES, RANKS

SF = "/root/testdata/sf0.01"
PATTERN = public_tokenizers.PATTERN


def encoder():
    return bpe.encoder(open(RANKS, "rb").read(), PATTERN)


def merged(ranks, piece):
    """Byte pair encoding of one match, the pair of least rank first."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
        at = min(range(len(pairs)), key=pairs.__getitem__)
        if pairs[at] == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def plain(ranks, text):
    # The library's engine counts white space by Unicode; regex's \s has four control characters more.
    pattern = PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"(?!\S)", r"(?!\P{White_Space})")
    return [i for m in regex.findall(pattern, text) for i in merged(ranks, m.encode())]


BLANKS = [" ", "\n", "\t", "\r\n", " \n", "　", "\xa0 ", "\x85 ", "\x1c", "  \n\n\t"]


@pytest.mark.parametrize("blanks", BLANKS)
def test_runs_of_white_space_equal_another_encoder(monkeypatch, blanks):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    monkeypatch.setattr(bpe, "LONG_BLANKS", re.compile(bpe.LONG_BLANKS.pattern.replace(str(1 << 14), "3")))
    monkeypatch.setattr(bpe, "PIECE_CHARS", 0)
    enc = encoder()
    for n in (2, 3, 4, 7, 40):
        run = (blanks * n)[:max(n, 2)]
        for text in (run, f"a{run}", f"{run}b", f"a{run}b", f"a{run}!", f"a{run}7{run}", f"{run}'s {run}é{run}", f"x{run}​{run}y"):
            want = plain(ranks, text)
            assert bpe.encode(enc, text).tolist() == want == enc.encode_ordinary(text)


def test_very_long_white_space_in_spark(spark):
    texts = {}
    for n in (1_000_000, 2_000_000, 10_000_000):
        for c in (" ", "\t", "\n"):
            texts[len(texts)] = "a" + c * n + "b"
    texts |= {20: " " * 10_000_000, 21: "\n" * 3_000_000 + "x", 22: "x \n\t" * 10 + " \r\n\t" * 600_000 + "end", 23: " " * 70_000 + "é" + "\t" * 2_000_000}
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(len(texts), "doc_id")
    rows = bpe.decode_ids(bpe.encode_texts(df, RANKS, PATTERN), RANKS, PATTERN)
    enc = encoder()
    # A shorter run of the same period gives the same ids, but for their number.
    for r in rows.selectExpr("doc_id", "sha2(decoded, 256) as decoded", "ids").collect():
        text = texts[r["doc_id"]]
        assert r["decoded"] == hashlib.sha256(text.encode()).hexdigest()
        ids = np.frombuffer(r["ids"], "<u4")
        if r["doc_id"] < 9:
            c, n = text[1], len(text) - 2
            short = enc.encode_ordinary("a" + c * 1000 + "b")
            assert len(ids) == len(short) - 1000 + n and ids[:500].tolist() == short[:500] and ids[-400:].tolist() == short[-400:]
            assert len(np.unique(ids[1:-2])) == 1


def test_query_equals_the_library(spark):
    """Every document of the table, in one call of the library."""
    enc = encoder()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op5_byte_level_bpe"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = enc.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
