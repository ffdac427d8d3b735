"""Incremental landing with Structured Streaming."""

from quarry.streaming.land_stream import land_stream  # noqa: F401
