"""Column expressions."""

from fumarole.functions.columns import (
    as_flag, co_correlation, finite, guarded_corr, indexed_value, micros, null_if_nan,
    parse_instant, utc_date, utc_hour, utc_text, weekend,
)

__all__ = [
    "as_flag", "co_correlation", "finite", "guarded_corr", "indexed_value", "micros",
    "null_if_nan", "parse_instant", "utc_date", "utc_hour", "utc_text", "weekend",
]
