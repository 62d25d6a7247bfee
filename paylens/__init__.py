"""Retail payment analytics on Spark: ingest, marts, published tables and reports."""
