"""Spark-native analytics for multi-channel image collections."""

__version__ = "0.1.0"
