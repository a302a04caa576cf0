"""gritmill: a Spark-native engine for curating security text corpora."""

__version__ = "0.1.0"
