"""Structured Streaming sinks, the outbox writer and progress metrics."""
