"""Structured Streaming: sources, scoring, sinks and live aggregates."""
