"""Data-quality rules, all measured in one pass."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fumarole.settings import N_CHANNELS, NORMALIZED_RANGE, READING_RANGE, SENSOR, TIME, VALUE


@dataclass(frozen=True)
class Rule:
    """A named condition on one column; ``low``/``high`` and ``members`` ignore nulls."""

    name: str
    column: str
    low: float | None = None
    high: float | None = None
    members: tuple | None = None

    def broken(self) -> Column:
        c = F.col(self.column)
        if self.members is not None:
            return c.isNotNull() & ~c.isin(*self.members)
        if self.low is not None:
            return c.isNotNull() & ~c.between(self.low, self.high)
        return c.isNull()


RULES = (
    Rule("sensor_id_non_null", SENSOR),
    Rule("timestamp_non_null", TIME),
    Rule("reading_range", VALUE, *READING_RANGE),
    Rule("reading_value_non_null", VALUE),
    Rule("normalized_range", "reading_normalized", *NORMALIZED_RANGE),
    Rule("anomaly_binary", "anomaly_flag", members=(0, 1)),
)


def _total(c: Column, name: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)


def _marks(rules) -> dict[str, Column]:
    """What is counted for the rules: rows that break one, and rows without its column."""
    marks = {f"_bad{i}": r.broken() for i, r in enumerate(rules)}
    return marks | {f"_null{i}": F.col(r.column).isNull() for i, r in enumerate(rules)}


def _entries(rules) -> Column:
    """The counts of ``_marks`` and ``row_count`` as an array, an entry for every rule."""
    return F.array(*[
        F.struct(
            F.lit(r.name).alias("name"),
            (F.col(f"_bad{i}") == 0).alias("success"),
            F.col("row_count").alias("element_count"),
            F.col(f"_bad{i}").alias("unexpected_count"),
            F.col(f"_null{i}").alias("missing_count"),
        )
        for i, r in enumerate(rules)
    ])


def report(df: DataFrame, rules=RULES, expected_sensors: int = N_CHANNELS) -> DataFrame:
    """One row: totals, consistency, and an entry for every rule.

    Rows are summed per key, then per sensor, then in all. That counts duplicates
    and sensors on the way, with partial sums before each shuffle.
    """
    marks = _marks(rules) | {"_missing": F.col(VALUE).isNull()}
    sums = [_total(c.cast("int"), name) for name, c in marks.items()]
    again = [_total(F.col(name), name) for name in marks]
    keyed = df.groupBy(SENSOR, TIME).agg(F.count("*").alias("_rows"), *sums)
    sensors = keyed.groupBy(SENSOR).agg(
        _total(F.col("_rows"), "_rows"), _total(F.col("_rows") - 1, "_repeats"), *again
    )
    whole = sensors.agg(
        _total(F.col("_rows"), "row_count"), _total(F.col("_repeats"), "duplicate_sensor_timestamp_rows"),
        F.count(SENSOR).alias("sensor_count"), *again,
    )
    consistent = (F.col("duplicate_sensor_timestamp_rows") == 0) & (F.col("sensor_count") == expected_sensors)
    checked = whole.select(
        "row_count", "sensor_count",
        (F.col("_missing") / F.nullif(F.col("row_count"), F.lit(0))).alias("missing_rate"),
        "duplicate_sensor_timestamp_rows",
        consistent.alias("consistency_ok"),
        _entries(rules).alias("expectations"),
    )
    success = F.col("consistency_ok") & F.forall("expectations", lambda e: e["success"])
    return checked.select(success.alias("success"), *checked.columns)


def check(df: DataFrame, rules=RULES) -> DataFrame:
    """One row per rule; no row is shuffled, as no rule needs the keys."""
    sums = [_total(c.cast("int"), name) for name, c in _marks(rules).items()]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *sums).select(F.inline(_entries(rules)))


def offenders(df: DataFrame, rules=RULES, limit: int = 20) -> DataFrame:
    """Up to ``limit`` example rows for every broken rule."""
    out = None
    for r in rules:
        part = df.where(r.broken()).limit(limit).select(
            F.lit(r.name).alias("name"), SENSOR, TIME, F.col(r.column).cast("string").alias("found")
        )
        out = part if out is None else out.unionByName(part)
    return out


def enforce(quality_report: DataFrame) -> DataFrame:
    """Raise when the report says the data failed; every rule has run by then."""
    row = quality_report.first()
    if not row["success"]:
        failed = [e["name"] for e in row["expectations"] if not e["success"]]
        if not row["consistency_ok"]:
            failed.append("consistency")
        raise ValueError("quality rules failed: " + ", ".join(failed))
    return quality_report
