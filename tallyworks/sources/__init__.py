"""Layouts, file scans, file topics and sinks."""
