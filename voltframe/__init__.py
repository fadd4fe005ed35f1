"""Spark-native operators for electricity and carbon analytics."""
