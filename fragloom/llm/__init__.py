"""Operators for preparing text corpora for model training.

Nothing outside this subpackage imports it.
"""
