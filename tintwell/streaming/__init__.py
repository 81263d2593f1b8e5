"""Structured Streaming forms of the append-only event log."""
