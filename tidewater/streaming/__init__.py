"""Structured Streaming forms: keyed state, sinks and runners."""
