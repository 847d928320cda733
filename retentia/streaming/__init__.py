"""Streaming ingestion of bronze files (the file-source form of the bronze load)."""

from retentia.streaming.ingest import SCHEMAS, ingest_bronze, ingest_csv

__all__ = ["SCHEMAS", "ingest_bronze", "ingest_csv"]
