"""Spark-native gene-context analytics; see README.md."""
