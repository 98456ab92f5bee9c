"""Sensor analytics on Spark: ingest, monitoring queries, features and models."""
