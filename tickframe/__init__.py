"""Spark-native analytics for time-stamped interaction recordings."""
