"""Column-to-Column functions."""

from .markdown import (
    detect_markdown,
    has_markdown_patterns,
    is_markdown_content,
    is_markdown_content_type,
    is_markdown_url,
    looks_like_html,
    markdown_title,
    title_or_url,
)
from .models import embedding_dims, enrichment_prompts
from .pages import html_title, html_to_markdown
from .text import decode_references, parse_tags, trim_ws, truncate_bytes
from .urls import (
    absolute_url,
    document_id,
    manifest_key,
    markdown_url_variants,
    object_key,
    object_name,
    scrape_prefix,
    scrape_run,
    url_host,
)

__all__ = [
    "absolute_url",
    "decode_references",
    "detect_markdown",
    "document_id",
    "embedding_dims",
    "enrichment_prompts",
    "has_markdown_patterns",
    "html_title",
    "html_to_markdown",
    "is_markdown_content",
    "is_markdown_content_type",
    "is_markdown_url",
    "looks_like_html",
    "manifest_key",
    "markdown_title",
    "markdown_url_variants",
    "object_key",
    "object_name",
    "parse_tags",
    "scrape_prefix",
    "scrape_run",
    "title_or_url",
    "trim_ws",
    "truncate_bytes",
    "url_host",
]
