"""Spark-native listings analytics: declarative DataFrame operators from raw text to serving queries."""
