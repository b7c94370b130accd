"""Column expressions built from Spark functions only."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ZONE = r":\d{2}[^:]*(?:[A-Za-z]|[+-]\d)"
BLANKS = " \t\r\n\f\x0b"
NUMBER = r"(?i)^[+-]?(?:inf(?:inity)?|(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?)$"


def indexed_value(c: Column) -> Column:
    """Number in a cell written as ``value`` or ``index:value``; null where there is none."""
    blanks = F.lit(BLANKS)
    tail = F.btrim(F.substring_index(F.btrim(c.cast("string"), blanks), ":", -1), blanks)
    digits = F.regexp_replace(tail, r"(?<=\d)_(?=\d)", "")
    return F.when(digits.rlike(NUMBER), digits.try_cast("double"))


def null_if_nan(c: Column) -> Column:
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def finite(c: Column) -> Column:
    """Null for NaN and both infinities, so that only NULL means missing afterwards."""
    x = null_if_nan(c)
    return F.when(F.abs(x) != F.lit(float("inf")), x)


def parse_instant(c: Column) -> Column:
    """Any ISO form to an instant, in UTC where it names no zone; null where the text is none."""
    plain = micros(c.try_cast("timestamp_ntz"), T.TimestampNTZType())
    # Spark reads a zone only behind seconds.
    zoned = F.regexp_replace(c, r"([T ]\d{2}:\d{2})(?=[Zz+-])", "$1:00")
    return F.when(c.rlike(ZONE), F.try_to_timestamp(zoned)).otherwise(F.timestamp_micros(plain))


def utc_date(ts: Column, dtype: T.DataType) -> Column:
    """The UTC date, whatever the session time zone."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.to_date(ts)
    return F.date_from_unix_date(F.floor(micros(ts, dtype) / 86_400_000_000).cast("int"))


def utc_hour(ts: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        return F.hour(ts)
    return F.floor(F.pmod(micros(ts, dtype), F.lit(86_400_000_000)) / 3_600_000_000).cast("int")


def weekend(day: Column) -> Column:
    """1 on Saturday and Sunday (``weekday`` counts from Monday = 0)."""
    return (F.weekday(day) >= 5).cast("int")


def as_flag(c: Column) -> Column:
    """0/1 as an integer, 0 where the condition is null."""
    return F.coalesce(c, F.lit(False)).cast("int")


def micros(ts: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970 as a long, order-preserving in every session time zone."""
    if isinstance(dtype, T.TimestampNTZType):
        day = F.unix_date(F.to_date(ts)) * F.lit(86_400_000_000)
        second = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("long") * F.lit(1_000_000)
        part = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
        return day + second + part
    return F.unix_micros(ts.cast("timestamp"))


def utc_text(ts: Column) -> Column:
    """ISO text of an instant in UTC, whatever the session zone."""
    micro = F.unix_micros(ts)
    day = F.date_from_unix_date(F.floor(micro / 86_400_000_000).cast("int"))
    second = F.pmod(micro, F.lit(86_400_000_000))

    def two(part: Column) -> Column:
        return F.lpad(part.cast("long").cast("string"), 2, "0")

    clock = F.concat(two(F.floor(second / 3_600_000_000)), F.lit(":"), two(F.floor(second / 60_000_000) % 60), F.lit(":"),
                     two(F.floor(second / 1_000_000) % 60), F.lit("."), F.lpad((second % 1_000_000).cast("string"), 6, "0"))
    return F.concat(day.cast("string"), F.lit("T"), clock, F.lit("Z"))


def _clipped(r: Column) -> Column:
    """Within [-1, 1]; null stays null, which ``least`` and ``greatest`` would skip."""
    return F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r)


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; null, not an error, when undefined."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    r = F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0))
    return _clipped(r)


def co_correlation(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """Correlation from the summed moments of a pair; null when one side is constant."""
    n = F.nullif(n, F.lit(0.0))  # two sensors may share no instant
    cov = sxy - sx * sy / n
    vx, vy = sxx - sx * sx / n, syy - sy * sy / n
    # Moments of a constant leave rounding dust; compare it with the size of the sums.
    tiny = F.lit(1e-13)
    real = (vx > tiny * sxx) & (vy > tiny * syy)
    r = F.when(real, cov / F.nullif(F.sqrt(vx * vy), F.lit(0.0)))
    return _clipped(r)
