"""Structured Streaming forms of the windows and panes."""
