"""Structured Streaming ingest of telemetry events."""
