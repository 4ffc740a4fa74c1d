"""Structured Streaming control flow for dataset lifecycle events."""
