"""Incremental loading with Structured Streaming (file-based sources)."""

from cadence.streaming.incremental import load_stream  # noqa: F401
