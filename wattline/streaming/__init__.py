"""Structured Streaming forms of scoring, live metrics and forward fill."""
