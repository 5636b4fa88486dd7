"""The catalogue of queries over tables."""
