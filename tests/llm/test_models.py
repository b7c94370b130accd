import numpy as np
import xxhash
from pyspark.sql import functions as F

from fumarole.llm import language, neighbours
from fumarole.llm.common import held_out
from fumarole.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_automaton_knows_all_factors_and_nothing_else():
    text = [1, 2, 1, 1, 2, 3, 1, 2, 1, 2]
    steps = language.suffix_automaton(text)

    def known(s):
        state = 0
        for c in s:
            if c not in steps[state]:
                return False
            state = steps[state][c]
        return True

    factors = {tuple(text[i:j]) for i in range(10) for j in range(i, 11)}
    import itertools
    for n in range(5):
        for s in itertools.product((1, 2, 3), repeat=n):
            assert known(s) == (s in factors)


def test_phrases_equal_a_plain_parsing():
    sample = "the quick brown fox jumps over the lazy dog and the other dog"
    p = language.Parser((("en", sample),))
    for text in ("the lazy fox", "zzz the dog", "over and over", "ü the"):
        symbols = p.symbols(text)
        learned = p.symbols(sample).tolist()
        factors = {tuple(learned[i:j]) for i in range(len(learned)) for j in range(i + 1, len(learned) + 1)}
        count, piece = 1, ()
        for c in symbols.tolist():
            if c != language.OTHER and (*piece, c) in factors:
                piece = (*piece, c)
            else:
                count, piece = count + 1, (c,) if c != language.OTHER and (c,) in factors else ()
        row = np.full((1, 64), p.fill, np.uint8)
        row[0, :len(symbols)] = symbols
        assert p.phrases(row)[0, 0] == count


def scripts(seed: int = 1) -> dict[str, list[str]]:
    """Texts of three languages, two of which have 600 letters of their own and 200 in common."""
    rng = np.random.default_rng(seed)
    alphabets = {"a": range(0x4E00, 0x4E00 + 800), "b": [*range(0x4E00, 0x4E00 + 200), *range(0xAC00, 0xAC00 + 600)], "c": range(97, 123)}
    out = {}
    for lang, letters in alphabets.items():
        words = ["".join(map(chr, rng.choice(letters, rng.integers(1, 4)))) for _ in range(900)]
        out[lang] = [" ".join(rng.choice(words, 12)) for _ in range(260)]
    return out


def test_two_scripts_of_many_letters(spark):
    texts = scripts()
    # The least sample has the fewest bits a phrase, so it takes whatever no automaton knows.
    samples = {lang: "\n".join(t[:200 if lang != "c" else 20]) for lang, t in texts.items()}
    rows = [(i, lang, t) for i, (lang, t) in enumerate((lang, t) for lang in texts for t in texts[lang][200:])]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs.drop("lang"), samples).collect()}
    assert [got[i] for i, _, _ in rows] == [lang for _, lang, _ in rows]


def test_hash_table_and_table_parse_alike(monkeypatch):
    texts = scripts(2)
    samples = tuple((lang, " ".join(t[:60])) for lang, t in texts.items())
    dense = language.Parser(samples)
    monkeypatch.setattr(language, "DENSE_CELLS", 0)
    sparse = language.Parser(samples)
    assert {type(x) for x in dense.automata} == {language.Dense} and {type(x) for x in sparse.automata} == {language.Sparse}
    rows = np.full((120, 80), dense.fill, dense.symbol.dtype)
    for i in range(120):
        symbols = dense.symbols("abc"[i % 3].join((texts["abc"[i % 3]][i + 60], "Q\u0416"))[:80])
        rows[i, :len(symbols)] = symbols
    assert (dense.phrases(rows) == sparse.phrases(rows)).all()


def test_sample_beside_copies_and_a_long_text(spark):
    rng = np.random.default_rng(3)
    texts = {lang: [lang + " ".join(map(str, rng.integers(0, 10**6, 15))) for _ in range(n)] for lang, n in (("a", 400), ("b", 400), ("c", 400), ("d", 3))}
    long, copied, wanted = "long " * 100_000, "copied " * 200, 4000
    held = {"a": [*texts["a"], long], "b": [*texts["b"], *[copied] * 5000], "c": texts["c"], "d": [*texts["d"], *texts["d"]]}
    docs = spark.createDataFrame([(lang, t) for lang, ts in held.items() for t in ts], "lang string, text string")
    got = language.learn(docs, wanted)
    for lang, ts in held.items():
        left, parts = wanted, []
        for t in sorted(set(ts), key=lambda t: (xxhash.xxh64_intdigest(t, 42) + 2**63) % 2**64):
            if left > 0:
                parts.append(t[:left])
                left -= len(parts[-1])
        assert got[lang] == "\n".join(parts)
        assert len(got[lang]) >= min(wanted, sum(map(len, set(ts))))


def test_held_out_languages(spark):
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op2_language_id"](spark, SF).join(lang, "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_languages(odd, none):
    samples = language.learn(odd)
    assert set(samples) == {"de", "en"} and max(map(len, samples.values())) <= language.SAMPLE_CHARS + 1
    got = [(r["doc_id"] or 0, r["lang_pred"]) for r in language.predict(odd, samples).collect()]
    assert len(got) == odd.count()
    assert {i for i, lang in got if lang == "und"} == {0, 2, 3, 4, 8} and (5, "de") in got
    assert {r["lang_pred"] for r in language.predict(odd, language.learn(none)).collect()} == {"und"}


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op7_quality_classifier"](spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["quality"] == r["predicted"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_scores_equal_plain_neighbours(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(~held_out(F.col("doc_id")))
    model = neighbours.learn(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    for r in neighbours.score(docs, model).collect():
        v = model.latent(neighbours.term_counts(r["text"])[None])[0]
        near = sorted(((float(v @ x), y) for x, y in zip(model.vectors, model.labels)), reverse=True)[:neighbours.NEIGHBOURS]
        votes = [(max(s, 0) ** 3, y) for s, y in near]
        assert abs(r["score"] - sum(a * y for a, y in votes) / sum(a for a, _ in votes)) < 2e-3


def test_odd_quality(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (8, 0), (None, 1), (7, None), (99, 1)], "doc_id long, quality int")
    scored = neighbours.score(odd, neighbours.learn(odd, labels), "mark")
    assert scored.columns == [*odd.columns, "mark"] and scored.count() == odd.count()
    assert {r["mark"] for r in scored.where("doc_id in (2, 3, 4)").collect()} == {0.5}
    assert {r["mark"] for r in neighbours.score(odd, neighbours.learn(none, labels), "mark").collect()} == {0.5}
    assert neighbours.score(none, neighbours.learn(odd, labels), "mark").count() == 0
