"""A Spark-native engine for turning media and documents into structured tables."""
