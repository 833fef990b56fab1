"""feedloom: a PySpark-native engine for article feeds and deal records."""

__version__ = "0.1.0"
