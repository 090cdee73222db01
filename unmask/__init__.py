"""Unmask: catalogue snapshots and entity matching as Spark DataFrame jobs."""
