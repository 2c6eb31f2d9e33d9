"""Clickstream-commerce analytics on Spark: ingest, profile, stage, star schema, reports."""

__version__ = "0.1.0"
