"""Incremental runs driven by Structured Streaming (see ``bookmark``)."""

from tidewater.streaming.bookmark import checkpoint_location, export_changes, ingest_changes  # noqa: F401
