"""Exact quantiles and the describe table, at any size."""

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fumarole.functions import null_if_nan
from fumarole.plans.sizing import bounded_rows, is_small

ACCURACY = 10_000
BRACKET_ROWS = 50_000
STATS = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]


def numbers(df: DataFrame, columns: list[str], *others: str) -> DataFrame:
    """The columns as doubles, NaN as null: the one rule of all statistics here."""
    return df.select(*others, *[null_if_nan(F.col(c).cast("double")).alias(c) for c in columns])


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], small: bool | None = None
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of every column, null and NaN skipped.

    The exact aggregate keeps every distinct value in one task, so it is used
    for inputs checked to be small. Otherwise order statistics are bracketed by
    a sketch and counted until the bracket is small, all columns in the same passes.
    """
    small = is_small(df) if small is None else small
    rows = numbers(df, columns)
    if small:
        at = F.array(*[F.lit(p) for p in probs])
        row = rows.agg(*[F.percentile(c, at).alias(c) for c in columns]).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in columns}
    sizes = rows.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    wanted = {c: (ranks_of(probs, n), n) for c, n in sizes.items() if n}
    found = column_order_statistics(rows, wanted)
    return {c: interpolated(found[c], probs, sizes[c]) if sizes[c] else [None] * len(probs) for c in columns}


def ranks_of(probs: list[float], n: int) -> set[int]:
    """0-based ranks that the quantiles of ``n`` values lie between."""
    return {r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}


def interpolated(found: dict[int, float], probs: list[float], n: int) -> list[float]:
    at = [p * (n - 1) for p in probs]
    return [_between(found[math.floor(h)], found[math.ceil(h)], h - math.floor(h)) for h in at]


def _between(low: float, high: float, part: float) -> float:
    """Equal ends need no arithmetic, which infinities would not survive."""
    return low if low == high else low * (1 - part) + high * part


@dataclass(frozen=True)
class Bracket:
    """Values from ``low`` to ``high``; ``below`` rows lie under it, ``inside`` rows in it."""

    low: float
    high: float
    below: int
    inside: int


def order_statistics(
    values: DataFrame, ranks: set[int], n: int, accuracy: int = ACCURACY, bracket_rows: int = BRACKET_ROWS
) -> dict[int, float]:
    """The values of ``x`` at 0-based ranks; see ``column_order_statistics``."""
    return column_order_statistics(values.select("x"), {"x": (ranks, n)}, accuracy, bracket_rows)["x"]


def column_order_statistics(
    rows: DataFrame, wanted: dict[str, tuple[set[int], int]], accuracy: int = ACCURACY, bracket_rows: int = BRACKET_ROWS
) -> dict[str, dict[int, float]]:
    """The values of every column at 0-based ranks, from ``wanted``: column to (ranks, number of values).

    A sketch proposes narrower brackets around the ranks, one count makes them certain; each round
    shrinks a bracket by about ``accuracy``. The ends of a bracket are counted on their own, so
    repeated values cannot stall it. A round is two aggregations for all columns together, and the
    rows of small brackets are read in one more. Null values are skipped, NaN must not be there.
    """
    open_: dict[tuple[str, int], Bracket] = {(c, r): Bracket(-math.inf, math.inf, 0, n) for c, (ranks, n) in wanted.items() for r in ranks}
    found: dict[str, dict[int, float]] = {c: {} for c in wanted}
    while wide := _by_bracket({at: b for at, b in open_.items() if b.inside > bracket_rows}):
        for c, r, known in _locate(rows, wide, _sketch(rows, wide, accuracy)):
            if isinstance(known, Bracket):
                open_[c, r] = known
            else:
                found[c][r] = known
                del open_[c, r]
    for c, r, x in _read_brackets(rows, _by_bracket(open_)):
        found[c][r] = x
    return found


Brackets = dict[tuple[str, Bracket], list[int]]


def _by_bracket(open_: dict[tuple[str, int], Bracket]) -> Brackets:
    """The ranks that are looked for in every bracket of a column."""
    out: Brackets = {}
    for (c, r), b in open_.items():
        out.setdefault((c, b), []).append(r)
    return out


def _inside(c: str, b: Bracket) -> Column:
    return F.when(F.col(c).between(b.low, b.high), F.col(c))


def _sketch(rows: DataFrame, brackets: Brackets, accuracy: int) -> list[list[float]]:
    """Per bracket, ends of narrower ones around its ranks, as likely as the sketch is accurate."""
    sketches = []
    for (c, b), ranks in brackets.items():
        at = [(r - b.below + 0.5) / b.inside + side * 2 / accuracy for r in ranks for side in (-1, 1)]
        at = sorted({min(1.0, max(0.0, q)) for q in at})
        sketches.append(F.percentile_approx(_inside(c, b), at, accuracy))
    row = rows.agg(*[x.alias(str(k)) for k, x in enumerate(sketches)]).first()
    return [sorted(set(ends)) for ends in row]


def _locate(rows: DataFrame, brackets: Brackets, ends: list[list[float]]) -> list[tuple[str, int, Bracket | float]]:
    """(column, rank, the end it falls on or the bracket between two ends that it falls in)."""
    counts = []
    for (c, b), cuts in zip(brackets, ends):
        x = _inside(c, b)
        counts.append(F.array(*[F.count(F.when(test, x)) for e in cuts for test in (x < e, x <= e)]))
    row = rows.agg(*[x.alias(str(k)) for k, x in enumerate(counts)]).first()
    out = []
    for ((c, b), ranks), cuts, upto in zip(brackets.items(), ends, row):
        edges = [0, *upto, b.inside]
        # Slot 2k is the values between the ends k - 1 and k, slot 2k + 1 is the end k itself.
        for s, (first, last) in enumerate(zip(edges, edges[1:])):
            k, on_end = divmod(s, 2)
            low = b.low if k == 0 else np.nextafter(cuts[k - 1], math.inf)
            high = b.high if k == len(cuts) else np.nextafter(cuts[k], -math.inf)
            known = cuts[k] if on_end else Bracket(float(low), float(high), b.below + first, last - first)
            out += [(c, r, known) for r in ranks if b.below + first <= r < b.below + last]
    return out


def _read_brackets(rows: DataFrame, brackets: Brackets) -> list[tuple[str, int, float]]:
    """(column, rank, value) from brackets with few rows, equal values counted once."""
    if not brackets:
        return []
    held = F.array(*[F.struct(F.lit(k).alias("k"), _inside(c, b).alias("x")) for k, (c, b) in enumerate(brackets)])
    few = (rows.select(F.explode(F.filter(held, lambda v: v["x"].isNotNull())).alias("v"))
           .groupBy("v.k", "v.x").agg(F.count(F.lit(1)).alias("n")))
    table = bounded_rows(few, sum(b.inside for _, b in brackets)).toArrow().sort_by([("k", "ascending"), ("x", "ascending")])
    ks, x, n = (table[c].to_numpy() for c in ("k", "x", "n"))
    out = []
    for k, ((c, b), ranks) in enumerate(brackets.items()):
        first, last = np.searchsorted(ks, [k, k + 1])
        upto = b.below + np.cumsum(n[first:last])
        out += [(c, r, float(x[first + np.searchsorted(upto, r, side="right")])) for r in ranks]
    return out


def describe(df: DataFrame, columns: list[str], small: bool | None = None) -> DataFrame:
    """One row per column: count, mean, deviation, extremes and exact quartiles; null and NaN skipped."""
    small = is_small(df) if small is None else small
    rows = numbers(df, columns)
    quartiles = [0.25, 0.5, 0.75]
    if small:
        at = F.array(*[F.lit(p) for p in quartiles])
        points = {c: F.percentile(c, at) for c in columns}
    else:
        exact = exact_quantiles(rows, columns, quartiles, small=False)
        points = {c: F.any_value(F.array(*[F.lit(v).cast("double") for v in exact[c]])) for c in columns}
    summary = rows.agg(*[
        F.struct(
            F.lit(c).alias("feature"), F.count(c).alias("count"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"), F.min(c).alias("min"), points[c].alias("q"),
            F.max(c).alias("max"),
        ).alias(c)
        for c in columns
    ])
    rows = summary.select(F.inline(F.array(*[F.col(c) for c in columns])))
    q = {f"q{int(p * 100)}": F.col("q")[i] for i, p in enumerate(quartiles)}
    return rows.withColumns(q).select("feature", *STATS)
