"""Spark-native banking-risk data engine: clean, validate, keep history, alert."""
