import hashlib
import re

import numpy as np
import pytest

from fumarole.llm import middle
from fumarole.llm.middle import Framed

TEXTS = ["", "a", "abc", " ", "ab cd, ef\n\ngh", "x" * 50, "é" * 20 + "abc" * 9, "漢字 kana かな!" * 5, "<P", "<<S>", "a<M>b", "P>S>M>", "𝒳y𝒳" * 7]


def units(text):
    return re.findall("[A-Za-z]+|[^A-Za-z]", text)


@pytest.mark.parametrize("chars", [1, 2, 3, 7, 1 << 14])
def test_every_unit_starts_where_it_is_found(chars):
    for text in TEXTS:
        f, at = Framed.of(text, frame_chars=chars), 0
        assert f.n == len(units(text)) and f.n_chars == len(text)
        for k, u in enumerate(units(text)):
            assert f.start_of(k) == at
            at += len(u)
        assert f.start_of(f.n) == len(text)
        for a in range(0, len(text) + 1, 3):
            for b in range(a, len(text) + 1, 4):
                assert b"".join(map(middle.content, f.part(a, b))).decode() == text[a:b]


def plain(text, doc_id, seed):
    h = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    u = units(text)
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return "plain", None, None, text
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return "spm" if h4 % 100 < 20 else "psm", len(p), len(m), out


@pytest.mark.parametrize("chars", [2, 5, 1 << 14])
def test_outputs_equal_plain_cuts_and_give_the_text_back(chars):
    forms = set()
    for doc_id in range(120):
        for text in TEXTS:
            form, p, m, frames = middle.arranged(Framed.of(text, frame_chars=chars), doc_id, 1)
            out = b"".join(map(middle.content, frames)).decode()
            assert (form, p, m, out) == plain(text, doc_id, 1)
            assert b"".join(middle.original(frames, form)).decode() == text
            forms.add(form)
    assert forms == {"plain", "psm", "spm"}


def test_only_cut_frames_are_opened(monkeypatch):
    words = np.random.default_rng(1).integers(0, 10**6, 40_000)
    text = " ".join(map(str, words))
    f = Framed.of(text, frame_chars=1000)
    opened = []
    monkeypatch.setattr(middle, "content", lambda frame, real=middle.content: opened.append(frame) or real(frame))
    form, *_, frames = middle.arranged(f, 3, 1)
    assert form != "plain" and len(f.frames) > 200 and len(set(opened)) <= 2
    assert len(set(frames) & set(f.frames)) >= len(f.frames) - 2


def test_rows_in_spark(spark, odd, none):
    long_run = [(100, "q" * 3_000_000), (101, "ß" * 200_000 + " end"), (102, None), (102, "<P>" * 9)]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(long_run, "doc_id long, text string"))
    for seed in (1, 2):
        made = middle.fill_in_middle(middle.framed_texts(docs, 1000), seed)
        got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["text"]) for r in middle.texts(made).collect()), key=repr)
        want = sorted(((r["doc_id"], len(units(r["text"] or "")), *plain(r["text"] or "", "" if r["doc_id"] is None else r["doc_id"], seed)) for r in docs.collect()), key=repr)
        assert got == want
    sums = middle.digests(made).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted(r["restored_sha256"] for r in sums) == sorted(sha(r["text"]) for r in docs.collect())
    assert sorted(r["output_sha256"] for r in sums) == sorted(sha(g[-1]) for g in got)
    assert middle.digests(middle.fill_in_middle(middle.framed_texts(none))).count() == 0
