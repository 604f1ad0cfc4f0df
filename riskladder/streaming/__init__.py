"""Incremental (streaming) form of the daily pre-rating."""

from riskladder.streaming.daily_stream import start_daily_stream

__all__ = ["start_daily_stream"]
