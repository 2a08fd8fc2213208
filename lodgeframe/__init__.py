"""lodgeframe: Spark-native layered analytics over listing-style tables."""
__version__ = "0.1.0"
