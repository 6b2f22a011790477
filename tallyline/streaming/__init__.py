"""Structured Streaming: audit events into the raw lake, status changes and usage as they happen."""

from tallyline.streaming.events import TOPICS, dedupe_events, parse_event, route, to_event
from tallyline.streaming.landing import Drain, caught_up, land_batch, land_raw, rejected, verify_landing
from tallyline.streaming.metering import land_usage, meter_hourly_stream
from tallyline.streaming.pipeline import audit_stream, run_pipeline
from tallyline.streaming.status import status_changes_stream

__all__ = [
    "Drain", "TOPICS", "audit_stream", "caught_up", "dedupe_events", "land_batch", "land_raw", "land_usage",
    "meter_hourly_stream", "parse_event", "rejected", "route", "run_pipeline",
    "status_changes_stream", "to_event", "verify_landing",
]
