"""Tidemark: a Spark-native batch analytics engine for star-schema data that arrives in daily drops."""
