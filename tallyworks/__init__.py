"""Keyed batch and event-stream analytics written as Spark DataFrame operators."""
