"""Spark-native engine that turns document collections into training datasets."""
