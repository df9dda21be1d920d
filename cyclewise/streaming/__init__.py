"""Structured Streaming: scoring micro-batches, stateful per-unit features, risk counts."""
