"""Writers: staged pages, manifests, the document table, the index, result rows."""

from .hits import hits_preview, hits_to_json
from .index import compact_index, create_index, open_index, update_index, write_index
from .staging import manifest_rows, stage_pages, write_manifests, write_objects
from .table import (
    compact_documents,
    create_document_table,
    drop_document_table,
    latest_by_id,
    read_document_table,
    upsert_documents,
)

__all__ = [
    "compact_documents",
    "compact_index",
    "create_document_table",
    "create_index",
    "drop_document_table",
    "hits_preview",
    "hits_to_json",
    "latest_by_id",
    "manifest_rows",
    "open_index",
    "read_document_table",
    "stage_pages",
    "update_index",
    "upsert_documents",
    "write_index",
    "write_manifests",
    "write_objects",
]
