"""Marketplace analytics on Spark: ingest, quality gate, history, star schema, marts."""
