"""Exact quantiles of a table that grows by days, where an added day reads only that day.

A state per day and column is kept in a folder: a mergeable sketch with the number of values, and for
every quantile the number of values below a bracket and the values inside it. Brackets come from the
merged sketches and are wider than the sketch errs, so they hold the wanted ranks, and go on to hold
them while the distribution drifts little. Merging the states then gives the quantile exactly, from
the few values inside. Only when a rank has left its bracket are brackets drawn anew, from the merged
sketches, and the values of all days counted against them once.
"""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fumarole.operators.quantiles import column_order_statistics, interpolated, numbers, ranks_of

#: Size of a sketch; it errs by about 0.1 % of the ranks.
SKETCH_K = 4096
#: Share of all ranks that a bracket reaches to either side of its quantile, doubled if that was too little,
#: and how many deviations more, for a quantile of other rows of the same distribution.
REACH, DEVIATIONS = 0.005, 4
SKETCHES = "column string, n long, sketch binary"
COUNTS = "column string, q int, low double, high double, below long, inside long"
INSIDE = "column string, q int, x double"


class QuantileStates:
    """The states in ``folder`` of ``columns`` by the days in column ``by``, for the quantiles ``probs``."""

    def __init__(self, spark: SparkSession, folder: str, columns: list[str], probs: list[float], by: str = "reading_date"):
        self.spark, self.folder, self.columns, self.probs, self.by = spark, folder, columns, probs, by
        self.brackets: dict[tuple[str, int], tuple[float, float]] = {}
        self.version = 0

    def add(self, days: DataFrame) -> None:
        """Take in all rows of one or several days; a day that is added again replaces its states."""
        rows = numbers(days, self.columns, self.by)
        states = rows.groupBy(self.by).agg(*[
            F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), F.kll_sketch_agg_double(c, SKETCH_K).alias("sketch")).alias(c)
            for c in self.columns])
        self._write(states.select(self.by, F.inline(F.array(*self.columns))), "sketches")
        if self.brackets:
            self._count(rows)

    def quantiles(self, all_days: Callable[[], DataFrame]) -> dict[str, list[float | None]]:
        """The quantiles of every column over all days; ``all_days`` is called if brackets have to be drawn anew."""
        merged = self._read("sketches", SKETCHES).groupBy("column").agg(
            F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch")).where("n > 0")
        sizes = {r["column"]: r["n"] for r in merged.select("column", "n").collect()}
        reach = REACH
        while (offsets := self._offsets(sizes)) is None:
            self._draw(merged, sizes, reach)
            self._count(numbers(all_days(), self.columns, self.by))
            reach *= 2
        return {c: self._read_out(c, sizes[c], offsets) if c in sizes else [None] * len(self.probs) for c in self.columns}

    def _draw(self, merged: DataFrame, sizes: dict[str, int], reach: float) -> None:
        """Brackets around all quantiles, from the merged sketches."""
        at = {c: [min(1.0, max(0.0, p + side * (reach + DEVIATIONS * math.sqrt(p * (1 - p) / n)))) for p in self.probs for side in (-1, 1)]
              for c, n in sizes.items()}
        ends = F.coalesce(*[F.when(F.col("column") == c, F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, x)))) for c, x in at.items()])
        for r in merged.select("column", ends.alias("ends")).collect():
            for q in range(len(self.probs)):
                (first, last), (low, high) = at[r["column"]][2 * q:2 * q + 2], r["ends"][2 * q:2 * q + 2]
                # The outermost values are never missed.
                self.brackets[r["column"], q] = (low if first > 0 else -math.inf, high if last < 1 else math.inf)
        self.version += 1

    def _count(self, rows: DataFrame) -> None:
        """Counts and inner values of ``rows`` for the brackets as they are, by day."""
        def each(build: Callable[[str, int, float, float], Column]) -> Column:
            return F.array(*[build(c, q, low, high) for (c, q), (low, high) in self.brackets.items()])

        def counts(c: str, q: int, low: float, high: float) -> Column:
            return F.struct(
                F.lit(c).alias("column"), F.lit(q).alias("q"), F.lit(low).alias("low"), F.lit(high).alias("high"),
                F.count(F.when(F.col(c) < low, 1)).alias("below"), F.count(F.when(F.col(c).between(low, high), 1)).alias("inside"))

        def value(c: str, q: int, low: float, high: float) -> Column:
            return F.struct(F.lit(c).alias("column"), F.lit(q).alias("q"), F.when(F.col(c).between(low, high), F.col(c)).alias("x"))

        per_day = rows.groupBy(self.by).agg(each(counts).alias("counts"))
        self._write(per_day.select(self.by, F.inline("counts")), f"counts-{self.version}")
        few = rows.select(self.by, F.explode(F.filter(each(value), lambda v: v["x"].isNotNull())).alias("v"))
        self._write(few.select(self.by, "v.*"), f"inside-{self.version}")

    def _offsets(self, sizes: dict[str, int]) -> dict[tuple[str, int], int] | None:
        """Values below each bracket, if all brackets hold their ranks."""
        if not sizes:
            return {}
        if not self.brackets:
            return None
        sums = self._read(f"counts-{self.version}", COUNTS).groupBy("column", "q").agg(F.sum("below").alias("below"), F.sum("inside").alias("inside"))
        held = {(r["column"], r["q"]): (r["below"], r["inside"]) for r in sums.collect()}
        for c, n in sizes.items():
            for q, p in enumerate(self.probs):
                below, inside = held.get((c, q), (0, 0))
                if any(not below <= r < below + inside for r in ranks_of([p], n)):
                    return None
        return {at: below for at, (below, _) in held.items()}

    def _read_out(self, c: str, n: int, offsets: dict[tuple[str, int], int]) -> list[float]:
        inside = self._read(f"inside-{self.version}", INSIDE).where(F.col("column") == c)
        spread = inside.select(*[F.when(F.col("q") == q, F.col("x")).alias(str(q)) for q in range(len(self.probs))])
        totals = spread.agg(*[F.count(k).alias(k) for k in spread.columns]).first().asDict()
        wanted = {str(q): ({r - offsets[c, q] for r in ranks_of([p], n)}, totals[str(q)]) for q, p in enumerate(self.probs)}
        found = column_order_statistics(spread, wanted)
        return [interpolated({r + offsets[c, q]: x for r, x in found[str(q)].items()}, [p], n)[0] for q, p in enumerate(self.probs)]

    def _write(self, rows: DataFrame, name: str) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.by)
         .parquet(f"{self.folder}/{name}"))

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(f"{schema}, `{self.by}` string").parquet(f"{self.folder}/{name}")
