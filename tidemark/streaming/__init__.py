"""Incremental file loading as a Structured Streaming job (availableNow
trigger, slice replacement per micro-batch)."""
