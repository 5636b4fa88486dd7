"""Incremental discovery of clips."""
