"""Readers and writers: raw telemetry, derived telemetry, layers, dimensions."""
