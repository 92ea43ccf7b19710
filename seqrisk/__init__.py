"""Timed-sequence analytics on Spark."""
