"""Spark-native cleaning, profiling, feature and model-evaluation operators for listing tables."""

__version__ = "0.1.0"
