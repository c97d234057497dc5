"""Readers for pages, staged scrapes, manifests, documents and seeds."""

from .pages import drop_http_errors, pages_from_table, scan_documents, scan_pages
from .seeds import select_sources
from .staged import scan_manifests, scan_staged_pages, scan_staged_table

__all__ = [
    "drop_http_errors",
    "pages_from_table",
    "scan_documents",
    "scan_manifests",
    "scan_pages",
    "scan_staged_pages",
    "scan_staged_table",
    "select_sources",
]
