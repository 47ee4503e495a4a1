"""Incremental versions of the daily tables."""
