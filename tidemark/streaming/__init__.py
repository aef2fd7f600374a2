"""Structured Streaming runners for the warehouse jobs."""

from tidemark.streaming.event_time import WATERMARK_DELAY, with_event_time

__all__ = ["WATERMARK_DELAY", "with_event_time"]
