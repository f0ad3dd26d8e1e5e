"""Spark-native anomaly analytics over many independent, ordered token streams."""
