"""Structured Streaming: message ingest, dedup, rolling features, alerts."""

from fumarole.streaming.batches import flush_rolling, late_readings, rolling_batches
from fumarole.streaming.ingest import (
    ARRIVAL, current_readings, ingest_messages, message_stream, stream_dedup,
)
from fumarole.streaming.rolling import stream_alerts, stream_rolling
from fumarole.streaming.scored import score_batches, scored, statistics, update_statistics
from fumarole.streaming.upsert import upsert_batches, upserted

__all__ = [
    "ARRIVAL", "current_readings", "flush_rolling", "ingest_messages", "late_readings", "message_stream",
    "rolling_batches", "score_batches", "scored", "statistics", "stream_alerts", "stream_dedup", "stream_rolling",
    "update_statistics", "upsert_batches", "upserted",
]
