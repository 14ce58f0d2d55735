"""Tidemark: a PySpark-native engine for event logs and their configuration history."""
