from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_queries import components

from fumarole.llm import bottomk
from fumarole.llm.jaccard import shingle_set


def test_least_overlap_is_the_tail_of_a_binomial():
    for num, den in ((80, 100), (9, 10), (1, 2)):
        t, p = bottomk.least_overlap(num, den), num / den
        tail = [comb(bottomk.K, i) * p**i * (1 - p) ** (bottomk.K - i) for i in range(bottomk.K + 1)]
        assert sum(tail[:t]) < bottomk.ERROR <= sum(tail[:t + 1])


def pair(rng, size, num=80):
    """Two sets with as many common elements as a link at num / 100 needs, and with one less."""
    union = int(size)
    shared = -(-num * union // 100)
    values = rng.choice(1 << 62, union, replace=False).astype(np.uint64)
    out = rng.integers(0, union - shared + 1)
    for less in (0, 1):
        both, left = values[:shared - less], values[shared - less:]
        yield np.sort(np.append(both, left[:out])), np.sort(np.append(both, left[out:]))


def test_no_link_fails_the_estimate_or_the_lists():
    rng = np.random.default_rng(1)
    for size in [*range(2, 400, 3), *rng.integers(400, 6000, 200)]:
        linked, other = pair(rng, size)
        a, b = (x[:bottomk.K] for x in linked)
        assert bottomk.sketches_alike(a, b, 80, 100)
        if size < bottomk.K:
            assert not bottomk.sketches_alike(*other, 80, 100)
        # In any order of all values, both have a common one in front.
        order = dict(zip(np.union1d(a, b).tolist(), rng.random(len(np.union1d(a, b)))))
        front = []
        for own, whole in zip((a, b), linked):
            t = -(-80 * len(whole) // 100) if 100 * len(whole) <= 80 * bottomk.K else bottomk.least_overlap(80, 100)
            front.append(set(sorted(own.tolist(), key=order.get)[:len(own) - t + 1]))
        assert front[0] & front[1]


def texts(rng, families=6, members=25):
    """Copies, near copies, chains, shared passages and texts around the threshold."""
    passage = [f"p{i}" for i in range(70)]
    out = []
    for f in range(families):
        base = [f"f{f}w{i}" for i in range(int(rng.integers(4, 400)))]
        for m in range(members):
            words = list(base)
            for _ in range(int(rng.integers(0, max(1, len(base) // 25)))):
                words[int(rng.integers(0, len(words)))] = f"x{rng.integers(0, 10**9)}"
            if m % 3 == 0:
                words = words[:int(rng.integers(0, len(words) + 1))] + passage + words[len(words) // 2:]
            out.append(" ".join(words))
    chain = [f"c{i}" for i in range(300)]
    out += [" ".join(chain[5 * i:] + [f"d{j}" for j in range(5 * i)]) for i in range(15)]
    return out + ["", None, " \n", "one two", "ONE two", "one two three four", "one two three four five", *out[:20]]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, seed):
    docs = dict(enumerate(texts(np.random.default_rng(seed))))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(6)
    got = {r["doc_id"]: r for r in bottomk.near_duplicates(df).collect()}
    want = components(docs, 4, 80)
    assert {i: r["component_id"] for i, r in got.items()} == want and len(set(want.values())) < len(docs) - 20
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_rows_without_id_carry_links(spark, odd, none):
    base = [f"w{i}" for i in range(100)]
    near = [" ".join(base[:100 - 7 * i] + [f"v{j}" for j in range(7 * i)]) for i in range(4)]
    rows = [(5, near[0]), (None, near[1]), (None, near[1]), (3, near[2]), (None, "alone and never seen again"), (None, "q r s t u"), (None, "q r s t u")]
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in bottomk.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(5, 3, False), (3, 3, True), (None, 3, False), (None, 3, False), *[(None, None, True)] * 3], key=repr)
    found = bottomk.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is not None) == sorted(
        [(1, 8, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 29997, 5), (6, 29997, 5), (7, 1, 7), (7, 1, 7), (8, 1, 8), (9, 8, 1), (9, 2, 9)])
    assert bottomk.near_duplicates(none).count() == 0
    named = spark.createDataFrame([("b", "one two three four"), ("a", "one two three four")], "doc_id string, text string")
    assert {r["component_id"] for r in bottomk.near_duplicates(named).collect()} == {"a"}


def test_a_common_passage_makes_no_lists(spark):
    """A passage in all documents is a list only for those that are made of it."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{passage} " + " ".join(f"d{i}w{j}" for j in range(90 if i else 8))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = docs.withColumns({"node": F.col("doc_id").cast("string")}).rdd.map(
        lambda r: (r["node"], [int(v) for v in shingle_set(r["text"], 4)[:bottomk.K].view(np.int64)]))
    sets = sets.map(lambda r: (r[0], len(r[1]), r[1])).toDF("node string, n long, values array<long>")
    assert bottomk.list_members(sets, 80, 100).count() <= 1


def test_a_text_between_two_heavier_ones_is_linked_with_both(spark):
    """All lists of x are of two members, x with y or x with z; y and z have more company than x."""
    rng = np.random.default_rng(5)
    def words(name, n):
        return [f"{name}{i}" for i in range(n)]
    common, xy, xz, of_y, of_z = words("c", 78), words("xy", 11), words("xz", 11), words("y", 11), words("z", 11)
    rows = [common + xy + xz, common + xy + of_y, common + xz + of_z]
    for own, name in ((of_y, "v"), (of_z, "u")):
        rows += [own + words(f"{name}both", 50) + words(f"{name}{i}own", 30) for i in range(2)]
    docs = {i: " ".join(rng.permutation(r)) for i, r in enumerate(rows)}
    got = bottomk.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), width=1)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == components(docs, 1, 80) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5, 6: 6}


def test_near_copies_below_the_threshold_are_not_fetched_pair_by_pair(spark, monkeypatch):
    """60 texts, each pair at 82 / 118: told apart by their sketches, not by 1770 pairs of sets."""
    common, asked, stored = [f"c{i}" for i in range(82)], [], bottomk.stored

    def counting(df, name):
        out = stored(df, name)
        if name == "pairs":
            asked.append(out.count())
        return out

    monkeypatch.setattr(bottomk, "stored", counting)
    docs = [(i, " ".join(common + [f"d{i}w{j}" for j in range(18)])) for i in range(60)]
    got = bottomk.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=1).collect()
    assert len(got) == 60 and all(r["kept"] for r in got)
    assert sum(asked) < 60
