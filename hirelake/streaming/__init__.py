"""Structured Streaming forms of the tracking and reporting operators."""
