"""Incremental twins of the batch jobs on Structured Streaming."""
