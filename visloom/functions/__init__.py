"""Spark-native correlator analytics."""
