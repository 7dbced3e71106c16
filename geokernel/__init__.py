"""Spark-native analytics for geometric reconstruction data."""
