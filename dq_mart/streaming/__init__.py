"""Incremental (file-stream) forms of the batch jobs."""
