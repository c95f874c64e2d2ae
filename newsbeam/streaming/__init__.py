"""Structured Streaming operators and the recurring job."""

from .cycle import (batch_sink, daily_scores, dedupe_by_store, dedupe_stream, drop_late,  # noqa: F401
                       latest_per_key, make_cycle, run_cycle, with_event_time)
