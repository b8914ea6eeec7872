"""Spark-native extraction, classification and checking of fees that are published as text."""
