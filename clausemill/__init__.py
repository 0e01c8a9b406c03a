"""A Spark-native engine for structured regulatory text."""
