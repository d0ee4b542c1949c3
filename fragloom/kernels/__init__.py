"""Sequence assembly in pure Python; nothing here knows Spark."""
