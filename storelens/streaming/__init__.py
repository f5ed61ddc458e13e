"""Structured Streaming queries over the same operators and plans as the batch jobs."""
