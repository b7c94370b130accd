"""Cross-parsing against plain Python, and languages of which hardly anything was learned."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fumarole.llm import language
from fumarole.llm.common import held_out

SF = "/root/testdata/sf0.01"


def symbols(text):
    out = []
    for c in text:
        c = language.folded(c) if c.isalpha() else " "
        if c != " " or not out or out[-1] != " ":
            out.append(c)
    return "".join(out)


def plain_bits(samples, text):
    """Bits by language: greedy longest pieces of the sample's symbols, anew every CHUNK symbols."""
    price = math.log2(max(2, *(len(symbols(s)) for s in samples.values())))
    known = {lang: symbols(s) for lang, s in samples.items()}
    rows = symbols(text)
    bits = {}
    for lang, sample in known.items():
        phrases = 0
        for at in range(0, len(rows), language.CHUNK):
            piece, phrases = "", phrases + 1
            for c in rows[at:at + language.CHUNK]:
                # A letter that the sample lacks ends a phrase and is not part of the next.
                if piece + c in sample and c in sample:
                    piece += c
                else:
                    phrases, piece = phrases + 1, c if c in sample else ""
        bits[lang] = phrases * price
    return bits


def test_bits_winner_and_score_equal_plain_parsing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    samples = {k: v[:1500] for k, v in language.learn(docs.where(~held_out(F.col("doc_id"))), 1500).items()} | {"xx": "ok"}
    few = {r["doc_id"]: r["text"] for r in docs.where("length(text) > 600").orderBy("doc_id").limit(40).collect()}
    few |= {-1: "Ω unknown letters ü only? " * 30, -2: "a", -3: "ok ok", -4: "一二三"}
    rows = spark.createDataFrame(list(few.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.predict(rows, samples).collect()}
    assert max(len(symbols(t)) for t in few.values()) > 4 * language.CHUNK
    for i, text in few.items():
        bits = plain_bits(samples, text)
        least = min(bits.values())
        assert got[i]["lang_pred"] == min(k for k, b in bits.items() if b == least)
        assert got[i]["score"] == pytest.approx(1 / sum(2 ** ((least - b) * language.SCORE_WEIGHT) for b in bits.values()), rel=1e-9)


def accuracy(spark, more):
    """Share of held-out documents whose language is found, with further labelled rows to learn from."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame(more, "text string, lang string").select(F.lit(None).cast("long").alias("doc_id"), "text", "lang")
    samples = language.learn(docs.where(~held_out(F.col("doc_id"))).unionByName(extra))
    found = language.predict(docs.drop("lang"), samples).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.where(held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.col("lang_pred") != "und")).collect()
    return np.mean([r["lang"] == r["lang_pred"] for r in rows])


@pytest.fixture(scope="module")
def alone(spark):
    return accuracy(spark, [("", "none")])


@pytest.mark.parametrize("more", [
    [("ok", "xx")], [("Hello there", "xx")], [("12345", "xx")], [("e", "xx"), ("12345 !", "yy"), ("ß", "zz")],
    [("the of and to in is that it was for on with as", "xx"), ("der die und in den von zu das mit sich des auf", "yy")],
])
def test_little_text_takes_nothing_over(spark, alone, more):
    assert alone > 0.98 and abs(accuracy(spark, more) - alone) <= 0.005


def test_samples_of_unequal_size(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null and length(text) > 300")
    learned, asked = docs.where(~held_out(F.col("doc_id"))), docs.where(held_out(F.col("doc_id")))
    samples = language.learn(learned)
    first = sorted(samples)[0]
    found = {}
    for cut in (None, len(samples[first]) // 100):
        some = samples | {first: samples[first][:cut]}
        rows = language.predict(asked.drop("lang"), some).join(asked.select("doc_id", "lang"), "doc_id").where(F.col("lang") != first).collect()
        found[cut] = np.mean([r["lang"] == r["lang_pred"] for r in rows])
    assert min(found.values()) > 0.98 and abs(np.subtract(*found.values())) <= 0.005
