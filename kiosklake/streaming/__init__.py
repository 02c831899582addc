"""Structured Streaming forms of the two jobs that ran on a timer."""
