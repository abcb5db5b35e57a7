"""Incident service-level analytics on Apache Spark."""
