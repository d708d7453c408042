"""Spark-native correlator ingest and quick-look analytics."""
