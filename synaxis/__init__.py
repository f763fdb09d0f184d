"""Spark-native analytics over public-procurement act tables."""
