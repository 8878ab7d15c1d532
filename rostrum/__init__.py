"""Spark-native analytics for large collections of parliamentary speeches."""
