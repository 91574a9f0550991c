"""Structured Streaming: file ingestion, windows with late data, effective-dated versions."""
