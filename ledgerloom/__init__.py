"""Spark-native document extraction and data-quality operators."""
