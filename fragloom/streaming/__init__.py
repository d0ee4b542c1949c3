"""Incremental ingest: planner, streaming job, commit log."""
