"""Compositions of operators: ingest, release, requests, model, forecast."""
