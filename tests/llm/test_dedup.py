import numpy as np
from test_queries import components

from fumarole.llm import jaccard, lines, substrings
from fumarole.llm.common import window_hashes, word_hashes


def test_parity_distance_never_above_the_difference():
    rng = np.random.default_rng(1)
    for n in (5, 60, 900):
        a = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        b = np.unique(np.concatenate([a[n // 5:], rng.integers(0, 1 << 63, n // 4, np.uint64)]))
        distance = sum(int(x).bit_count() for x in (jaccard.parity_sketch(a) ^ jaccard.parity_sketch(b)).view(np.uint64))
        assert distance <= len(np.setxor1d(a, b))


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(2)
    for num in (80, 90):
        starts = jaccard.band_starts(num, 100)
        for _ in range(400):
            a = np.unique(rng.integers(0, 1 << 63, int(rng.integers(4, 120)), np.uint64))
            room = jaccard.difference_bound(2 * len(a), num, 100)
            out = int(rng.integers(0, room + 1)) // 2
            b = np.unique(np.concatenate([a[out:], rng.integers(0, 1 << 63, room // 2, np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < num * (len(a) + len(b) - both) or np.array_equal(a, b):
                continue
            keys = [set(), set()]
            for s, k in zip((a, b), keys):
                own = int(np.searchsorted(starts, len(s), "right")) - 1
                for g in (own, own + 1):
                    if jaccard.band_cut(g, num, 100)[0]:
                        k.update(jaccard.sketch_keys(s, g, num, 100).tolist())
            assert keys[0] & keys[1]


def test_chains_and_odd_documents(spark, odd, none):
    base = [f"w{i}" for i in range(200)]
    rows = [(100 + i, " ".join(base[:200 - 4 * i] + [f"v{i}" for i in range(4 * i)])) for i in range(12)]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    got = jaccard.near_duplicates(docs, 5, (80, 100)).collect()
    assert len(got) == docs.count()
    want = components(dict(rows), 5, 80)
    assert {r["doc_id"]: r["component_id"] for r in got if (r["doc_id"] or 0) >= 100} == want
    small = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None and r["doc_id"] < 100)
    assert small == sorted([(1, 7, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 29996, 5), (6, 29996, 5), (7, 1, 7), (7, 1, 7), (8, 1, 8), (9, 7, 1), (9, 1, 9)])
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {None}
    stay = jaccard.one_of_each(odd)
    assert stay.columns == odd.columns
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:5]) for r in stay.collect()) == [
        (0, ""), (0, "no id"), (1, "one t"), (2, ""), (3, ""), (4, " \n\t "), (5, "word0"), (7, "x"), (8, "1234 "), (9, "anoth")]
    assert jaccard.near_duplicates(none).count() == 0


def test_lines(spark, odd, none):
    rows = [(3, "Common line here\n\nown text of three"), (1, "  common LINE here\t\nshort\nshort"), (2, "short\ncommon line here\ncommon line here"),
            (2, "short\ncommon line here\ncommon line here"), (None, "common line here"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["text"]): r["n_dropped"] for r in lines.with_bitmaps(docs, lines.line_bitmaps(docs)).collect()}
    assert got == {(3, "\nown text of three"): 1, (1, rows[1][1]): 0, (2, "short"): 2, (None, "common line here"): 0, (4, ""): 0, (5, ""): 0}
    assert lines.with_bitmaps(docs, lines.line_bitmaps(docs)).count() == len(rows)
    plain = odd.withColumnsRenamed({"score": "n_lines"})
    kept = lines.without_repeats(plain)
    assert kept.columns == plain.columns and kept.count() == odd.count()
    texts = {(r["doc_id"], "none" if r["text"] is None else r["text"][:5]) for r in kept.collect()}
    assert {(2, "none"), (6, ""), (9, ""), (9, "anoth"), (5, "word0")} <= texts
    assert lines.without_repeats(none).count() == 0


def plain_repeats(docs, window):
    first, out = {}, {}
    for i in sorted(docs):
        w = docs[i].encode().split()
        gone = set()
        for p in range(len(w) - window + 1):
            x = tuple(w[p:p + window])
            if first.setdefault(x, (i, p)) != (i, p):
                gone.update(range(p, p + window))
        out[i] = (len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode())
    return out


def test_passages_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    passages = [" ".join(f"p{k}_{i}" for i in range(20 + k)) for k in range(6)]
    docs = {}
    for i in range(120):
        parts = []
        for _ in range(rng.integers(1, 5)):
            parts.append(" ".join(f"w{x}" for x in rng.integers(0, 4000, rng.integers(0, 30))))
            parts.append(passages[rng.integers(0, 6)] if rng.random() < 0.6 else "la " * int(rng.integers(0, 50)))
        docs[i] = " \n".join(parts)
    docs[200] = docs[7]
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in substrings.without_repeats(df).collect()}
    assert got == plain_repeats(docs, 20)


def test_cover_brings_any_two_positions_together():
    p = substrings.PERIOD
    marks = {(a - b) % p for a in substrings.COVER for b in substrings.COVER}
    assert marks == set(range(p)) and substrings.anchor_width(20) + p - 1 == 20


def test_passages_of_odd_documents(odd, none):
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substrings.without_repeats(odd).collect())
    assert got == [(0, 0, 0), (0, 5, 0), (1, 11, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0), (5, 30000, 0), (6, 30000, 30000),
                   (7, 1, 0), (7, 1, 0), (8, 2, 0), (9, 5, 0), (9, 11, 0)]
    assert substrings.without_repeats(none).count() == 0


def test_window_hashes():
    h = word_hashes(b"a b c a b c".split())
    w = window_hashes(h, 3)
    assert len(w) == 4 and w[0] == w[3] and len(set(w.tolist())) == 3 and len(window_hashes(h, 7)) == 0


def test_sets_that_only_rows_without_id_hold_carry_links(spark):
    base = [f"w{i}" for i in range(300)]
    near = [" ".join(base[:300 - 12 * i] + [f"v{j}" for j in range(12 * i)]) for i in range(5)]
    rows = [(9, near[0]), (None, near[1]), (None, near[1]), (4, near[2]), (None, near[3]), (7, near[4]), (None, "q r s t u v"), (None, "q r s t u v")]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, (90, 100)).collect()
    assert sorted((repr(r["doc_id"]), r["component_id"]) for r in found if r["n_shingles"] > 100) == [
        ("4", 4), ("7", 4), ("9", 4), ("None", 4), ("None", 4), ("None", 4)]
    assert [r["component_id"] for r in found if r["n_shingles"] < 100] == [None, None]
