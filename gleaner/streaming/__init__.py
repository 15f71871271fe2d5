"""Structured Streaming forms of the periodic, stateful runs (H1-H4)."""
