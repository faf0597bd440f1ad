"""Spark-native operators for preparing and analysing document, conversation and inference data."""

__version__ = "0.1.0"
