"""Queries over the driver's tables and their SQL twins."""
