"""Column functions: binary frame records, times, names and overlay texts."""
