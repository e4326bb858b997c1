"""Spark-native analytics for integration-site sequencing data and training-data preparation."""
