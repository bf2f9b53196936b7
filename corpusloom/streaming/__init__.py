"""Structured Streaming: request scoring, request limits, request metrics."""
