"""Quality rules as a cascade that asks cheap and telling rules first.

A sample tells what each rule costs and how many rows it rejects. Cost is what the rule reads of the
sampled rows, in characters, weighted by how they are read; unlike seconds, that is the same each time
and on any machine. The rules are then asked in the order of rejections per cost, and a rejected row is
asked no further: one nested CASE, of which Spark evaluates a branch only where those before it did
not hold. The verdict does not depend on the order. Spark expressions only.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fumarole.llm.common import WORD, fresh

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Words of a window whose repetition counts.
WINDOW = 5
SAMPLE_ROWS = 2000
#: What a character costs a regular expression, where one that is only counted costs 1.
BY_PATTERN = 10


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Null texts count as empty: all measures are 0, n_lines too. Columns of ``docs`` with such a
    name are replaced. Windows are compared by their 64-bit hashes within a text; the work is
    n log n in the words of a text. The measures leave a generator, so a filter on them is asked
    after they were taken once, and never moves their expressions into each other's lambdas.
    """
    names = [fresh(docs, f"rule_{c}") for c in ("words", "hashes", "sorted", "starts", "bits", "lines")]
    words, hashes, packed, starts, bits, lines = names
    whole = F.coalesce(F.col(text), F.lit(""))
    last = F.size(hashes) - 1
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(WINDOW))))
    none = F.array().cast("array<bigint>")
    # Hash and start in one integer: the starts take as many of its bits as the text needs.
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(bits)) - 1
    pack = F.transform(hashes, lambda h, i: h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")))

    def start(j: Column) -> Column:
        return F.get(packed, j).bitwiseAND(mask).cast("int")

    def equal(i: Column, j: Column) -> Column:
        return F.get(hashes, start(i)) == F.get(hashes, start(j))

    again = F.filter(F.sequence(F.lit(0), last), lambda j: F.coalesce(
        ((j > 0) & equal(j, F.greatest(j - 1, F.lit(0)))) | ((j < last) & equal(j, F.least(j + 1, last))), F.lit(False)))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a.n + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")), lambda a: a.n)
    with_word = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    measures = {
        "n_words": F.size(words), "word_chars": F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)),
        "n_lines": F.size(lines), "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_symbols": F.length(whole) - F.length(F.translate(whole, SYMBOLS, "")), "n_repeat_words": covered}
    taken = F.inline(F.array(F.struct(*(c.cast("long").alias(name) for name, c in measures.items()))))
    return (
        docs.withColumns({words: F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)), lines: with_word})
        .withColumn(hashes, F.when(F.size(words) >= WINDOW, windows).otherwise(none))
        .withColumn(bits, F.length(F.bin(F.size(hashes))))
        .withColumn(packed, F.sort_array(pack))
        .withColumn(starts, F.sort_array(F.transform(F.when(F.size(hashes) > 1, again).otherwise(F.array().cast("array<int>")), start)))
        .select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in measures), taken))


def rule_order(sample: DataFrame, rules: Mapping[str, Column], costs: Mapping[str, Column] | None = None) -> list[str]:
    """Names of ``rules`` by rejected rows per cost on ``sample``, the most first, equal ones by name.

    ``costs`` maps names to what a row costs its rule, in characters read; others cost 1, as rules on
    numbers do. One aggregation; null costs count as 1.
    """
    costs = costs or {}
    rejected = [F.count(F.when(rule, 1)).alias(f"rejected_{i}") for i, rule in enumerate(rules.values())]
    spent = [F.sum(F.greatest(F.coalesce(costs.get(name, F.lit(1)), F.lit(1)), F.lit(1))).alias(f"spent_{i}") for i, name in enumerate(rules)]
    row = sample.agg(*rejected, *spent).first()
    worth = {name: row[f"rejected_{i}"] / (row[f"spent_{i}"] or 1) for i, name in enumerate(rules)}
    return sorted(rules, key=lambda name: (-worth[name], name))


def some_rows(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` rows of ``docs`` and twice as many at most, drawn as the table is read."""
    share = min(1.0, rows / max(1, docs.count()))
    return docs.sample(share, seed=0).limit(2 * rows)


def cascade(docs: DataFrame, rules: Mapping[str, Column], sample: DataFrame, verdict: str = "kept",
            costs: Mapping[str, Column] | None = None) -> DataFrame:
    """``docs`` with ``verdict``: true where none of ``rules`` holds; a rule that is null holds not.

    ``rules`` maps names to conditions that reject a row, ``costs`` see ``rule_order``. Cost and selectivity are those on
    ``sample``, rows with the columns that the rules read; they decide the order of the rules and
    nothing else, so an empty table and repeated rows are fine.
    """
    kept = F.lit(True)
    for name in reversed(rule_order(sample, rules, costs)):
        kept = F.when(rules[name], F.lit(False)).otherwise(kept)
    return docs.withColumn(verdict, kept)


def standard_rules(text: str = "text") -> dict[str, Column]:
    """Rules on top of ``text_measures``, for prose in any script; each holds for text to reject."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def characters(kind: str) -> Column:
        return F.length(whole) - F.length(F.regexp_replace(whole, rf"\p{{{kind}}}+", ""))

    letters = characters("L")
    return {
        "few words": F.col("n_words") < 10,
        "repeated windows": 100 * F.col("n_repeat_words") > 20 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "repeated lines": (F.col("n_lines") >= 4) & (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        "word length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words")),
        "shouting": 10 * characters("Lu") > 4 * letters,
        "exclamations": 10 * F.regexp_count(whole, F.lit(r"[!?]{2}")) > F.col("n_words"),
        "few letters": 2 * letters < F.col("word_chars"),
    }


def standard_costs(text: str = "text") -> dict[str, Column]:
    """What ``standard_rules`` read of a row; those that are not here read numbers only."""
    chars = F.length(F.coalesce(F.col(text), F.lit("")))
    characters = (2 + BY_PATTERN) * chars  # two lengths and a pattern
    return {"shouting": 2 * characters, "few letters": characters, "exclamations": BY_PATTERN * chars}
