"""Spark-native analytics for scientific-instrument data operations."""
