"""Metadata-driven incremental table ingestion, expressed as Spark DataFrame jobs."""

__version__ = "0.1.0"
