"""Spark-native multi-table feature engineering and binary-classifier evaluation."""

__version__ = "0.1.0"
