"""Spark-native engine for gridded emission data."""
