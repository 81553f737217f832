"""Incident analytics on Spark: ingest, release, features, model and daily forecast."""
