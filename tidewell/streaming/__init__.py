from .events import (
    counter_totals, drop_repeats, read_counters, read_events, read_marks, start_event_counters, start_event_stream,
)
from .threads import read_thread_replies, settle_orphans, start_thread_stream

__all__ = [
    "counter_totals", "drop_repeats", "read_counters", "read_events", "read_marks", "start_event_counters",
    "start_event_stream", "read_thread_replies", "settle_orphans", "start_thread_stream",
]
