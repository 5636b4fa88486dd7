"""Operators over DataFrames: carving, gaps, overlays, noise fingerprints, similarity, order and reports."""
