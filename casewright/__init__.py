"""Spark-native analytics over long legal texts."""

__version__ = "0.1.0"
