"""Readers and the step from wide records to long readings."""

from fumarole.sources.readers import (
    message_frame, read_messages, read_parquet_any, read_report, read_wide_csv,
)
from fumarole.sources.reshape import (
    canonicalize, channel_starts, feature_columns, pick_channels, positional_join, union_sources,
    usable_counts, wide_to_long, with_instants,
)

__all__ = [
    "canonicalize", "channel_starts", "feature_columns", "message_frame", "pick_channels",
    "positional_join", "read_messages", "read_parquet_any", "read_report", "read_wide_csv",
    "union_sources", "usable_counts", "wide_to_long", "with_instants",
]
