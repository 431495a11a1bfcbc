"""Spark-native analytics for occurrence records, hexagon maps, dataset catalogues and text corpora."""

__version__ = "0.1.0"
