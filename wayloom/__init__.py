"""Spark-native pedestrian-map analytics: see README.md."""
