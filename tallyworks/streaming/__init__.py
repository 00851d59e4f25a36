"""Structured Streaming forms of the file-arrival jobs.

All sinks are parquet file sinks with a checkpoint, so every input file counts exactly once, also
after a restart.
"""
