"""Structured Streaming entry points."""
from .ingest import hourly_stream, land, latest_stream, refresh_stream

__all__ = ["hourly_stream", "land", "latest_stream", "refresh_stream"]
