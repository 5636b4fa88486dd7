"""Spark-native analytics for recovered recordings, declared over DataFrames."""
