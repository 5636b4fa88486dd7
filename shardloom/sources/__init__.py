"""Scans of folders of clips and the fingerprint cache."""
