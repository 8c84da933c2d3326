"""A Spark-native engine that turns personal data into a releasable form."""
__version__ = "0.1.0"
