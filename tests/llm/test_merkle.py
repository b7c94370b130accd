import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from fumarole.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(leaves, fanout):
    """{(group, place): (subroot, root, path)} of lists of digests by group, level by level in plain Python."""
    def paths(nodes):
        found = [[] for _ in nodes]
        own, level = list(range(len(nodes))), nodes
        while len(level) > 1:
            runs = [level[i:i + fanout] for i in range(0, len(level), fanout)]
            for k, at in enumerate(own):
                run, j = runs[at // fanout], at % fanout
                found[k].append(("".join(run[:j]), "".join(run[j + 1:])))
                own[k] = at // fanout
            level = [sha(*run) for run in runs]
        return level[0], found

    groups = sorted(leaves)
    lower = {g: paths(leaves[g]) for g in groups}
    root, upper = paths([lower[g][0] for g in groups])
    return {(g, i): (lower[g][0], root, lower[g][1][i] + upper[k]) for k, g in enumerate(groups) for i in range(len(leaves[g]))}


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_manifest_equals_plain_trees(spark, fanout):
    sizes = {"": 1, "0": 2, "0a": fanout, "0b": fanout + 1, "0c": fanout * fanout + 1, "0d": 150, "0é": 7}
    if fanout < 16:
        sizes |= {f"0x{i}": 1 for i in range(fanout * fanout)}
    leaves = {g: [sha(g, str(i)) for i in range(n)] for g, n in sizes.items()}
    rows = [(g, i * 3, d, "other") for g, ds in leaves.items() for i, d in enumerate(ds)]
    df = spark.createDataFrame(rows, f"{merkle.GROUP} string, doc_id long, digest string, slot string").repartition(5, "digest")
    got = merkle.manifest(df, fanout).withColumn("again", merkle.folded(F.col("digest"), F.col("path"))).withColumn("proof", merkle.proof_hash(F.col("path")))
    got = got.collect()
    want = plain({g.encode(): ds for g, ds in leaves.items()}, fanout)
    assert len(got) == len(rows) and {r["slot"] for r in got} == {"other"}
    for r in got:
        subroot, root, path = want[r[merkle.GROUP].encode(), r["doc_id"] // 3]
        assert (r["subroot"], r["root"], r["again"]) == (subroot, root, root)
        assert [(s["before"], s["after"]) for s in r["path"]] == path
        assert r["proof"] == sha(*(x + y for x, y in path))


def test_leaves_tell_rows_apart(spark):
    rows = [(1, "ab", None), (1, "a", "b"), (1, None, "ab"), (1, "-", None), (1, "", ""), (None, "é", "É")]
    got = [r[0] for r in spark.createDataFrame(rows, "i long, x string, y string").select(merkle.leaf_hash(*map(F.col, "ixy"))).collect()]
    want = [sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r)) for r in rows]
    assert got == want and len(set(got)) == len(rows)
    texts = ["ÀÉ Ab", "Ab", "", None, "İ"]
    low = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(merkle.lower_ascii(F.col("t"))).collect()]
    assert low == ["ÀÉ ab", "ab", "", None, "İ"]


def test_odd_and_repeated_rows(spark, odd, none):
    def leaves(docs):
        return docs.select("doc_id", merkle.group_key(F.col("source")).alias(merkle.GROUP), merkle.leaf_hash(F.col("doc_id"), F.col("text")).alias("digest"), "keep")

    got = merkle.manifest(leaves(odd.unionByName(odd)), 3).withColumn("again", merkle.folded(F.col("digest"), F.col("path"))).collect()
    assert len(got) == 2 * odd.count() and len({r["root"] for r in got}) == 1
    assert all(r["again"] == r["root"] for r in got) and {r["keep"] for r in got} == {"taken"}
    assert merkle.manifest(leaves(none)).count() == 0
    one = merkle.manifest(leaves(odd.limit(1))).first()
    assert one["digest"] == one["subroot"] == one["root"] and one["path"] == []


def test_a_changed_leaf_is_found(spark):
    rows = [(f"0{i % 4}", i, sha(str(i)), sha("bad") if zlib.crc32(str(i).encode()) % 5 == 0 else sha(str(i))) for i in range(400)]
    df = spark.createDataFrame(rows, f"{merkle.GROUP} string, doc_id long, digest string, suspect string")
    found = merkle.manifest(df).select("doc_id", (merkle.folded(F.col("suspect"), F.col("path")) == F.col("root")).alias("ok"))
    assert {r["doc_id"] for r in found.where("not ok").collect()} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
