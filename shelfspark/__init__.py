"""shelfspark: a PySpark-native engine for enriching, checking and evaluating catalog and text records."""

__version__ = "0.1.0"
