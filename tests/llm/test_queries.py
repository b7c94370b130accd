"""Registered queries against their SQL, and the pipeline's stages against plain Python."""

import hashlib
import re

import pytest
from compare import connect, differences

import corpus_pipeline
from fumarole.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == ""


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = [r.asDict() for r in docs.collect()]
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name.replace(" ", "-"))
        assert docs.columns == columns
        kept.append((name, rows, [r.asDict() for r in docs.collect()]))
    (_, given, good), (_, before, lined), (_, _, unique), (_, _, mixed) = kept

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    passed = {r["doc_id"] for r in good}
    clean = [i for i, q in labels.items() if q == 1]
    assert sum(i in passed for i in clean) >= 0.99 * len(clean)
    junk = [i for i, q in labels.items() if q == 0]
    assert sum(i not in passed for i in junk) >= 0.95 * len(junk)

    holders: dict[str, set[int]] = {}
    for r in before:
        for line in r["text"].split("\n"):
            holders.setdefault(key(line), set()).add(r["doc_id"])
    want = {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if len(key(x)) < 10 or min(holders[key(x)]) == r["doc_id"]) for r in before}
    assert {r["doc_id"]: r["text"] for r in lined} == want
    assert all(r["n_chars"] == len(r["text"]) for r in lined)

    parent = components({r["doc_id"]: r["text"] for r in lined}, 5, 80)
    assert {r["doc_id"] for r in unique} == {i for i, p in parent.items() if i == p}

    copies = {}
    for r in mixed:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert set(copies) <= {r["doc_id"] for r in unique} and max(copies.values()) <= 3
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in tokens) == sorted((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in mixed)


def key(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).encode().lower().decode()


def components(texts, width, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + width]) for j in range(max(1, len(w) - width + 1))} if w else set()
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    order = sorted((i for i in sets if sets[i]), key=lambda i: len(sets[i]))
    for n, a in enumerate(order):
        for b in order[n + 1:]:
            if 100 * len(sets[a]) < percent * len(sets[b]):
                break
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in texts}
