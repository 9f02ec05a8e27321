"""Spark-native operators for building and auditing parallel text corpora."""

__version__ = "0.1.0"
