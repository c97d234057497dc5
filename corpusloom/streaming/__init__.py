"""Ingestion of finished scrapes, as a stream or for one prefix."""

from .ingest import (
    IngestOptions,
    IngestResult,
    ingest_prefix,
    ingest_scrapes,
    stream_ingest,
    stream_manifests,
)

__all__ = ["IngestOptions", "IngestResult", "ingest_prefix", "ingest_scrapes", "stream_ingest", "stream_manifests"]
