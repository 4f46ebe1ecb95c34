"""A PySpark-native engine for document intelligence."""
