"""Spark-native record-change engine: canonical identities, reconciliation, gates, views and search."""
