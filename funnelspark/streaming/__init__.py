"""Incremental ingestion of analytics export files into the landing table."""

from .ingest import export_stream, ingest_exports  # noqa: F401
