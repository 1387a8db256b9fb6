"""Structured Streaming forms of the stateful operators, and query helpers."""
