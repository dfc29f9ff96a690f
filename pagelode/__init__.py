"""pagelode: a Spark-native engine for source-grounded document evidence."""

__version__ = "0.1.0"
