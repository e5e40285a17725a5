"""Spark-native analytics for motorsport timing data."""
