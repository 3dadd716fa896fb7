"""Nested-record ingestion and normalisation on Spark."""
