"""Spark-native reporting mart for aggregated lending activity."""
