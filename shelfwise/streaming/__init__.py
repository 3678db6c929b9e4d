"""Structured Streaming: event parsing, landing jobs, real-time pricing."""

from shelfwise.streaming.events import (
    clean_clickstream,
    clean_competitor,
    encode_events,
    parse_events,
    realtime_pricing,
)
from shelfwise.streaming.jobs import (
    land_clickstream,
    land_competitor_prices,
    land_realtime_pricing,
    read_topic,
    write_stream,
)

__all__ = ["clean_clickstream", "clean_competitor", "encode_events", "land_clickstream",
           "land_competitor_prices", "land_realtime_pricing", "parse_events",
           "read_topic", "realtime_pricing", "write_stream"]
