"""From pages to documents."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    detect_markdown,
    document_id,
    html_to_markdown,
    markdown_title,
    title_or_url,
)
from ..schemas import DOCUMENT_SCHEMA
from .enrich import EmbeddingModel, TextModel, check_dims, embed, enrich

OPTIONAL_FIELDS = ("tags", "summary", "embedding")


def html_to_markdown_job(pages: DataFrame, html_col: str = "body") -> DataFrame:
    """Add ``markdown``, ``title`` and ``error`` to a table of HTML pages."""
    converted = pages.withColumn("_converted", html_to_markdown(html_col))
    return converted.select(
        *pages.columns,
        F.col("_converted.markdown").alias("markdown"),
        F.col("_converted.title").alias("title"),
        F.col("_converted.error").alias("error"),
    )


def build_documents(
    pages: DataFrame,
    make_text_model: Callable[[], TextModel] | None = None,
    make_embedding_model: Callable[[], EmbeddingModel] | None = None,
    dims: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Document columns plus ``error`` (null when the page was processed).

    One scan: Markdown bodies pass through, only the others are handed to the
    converter. A stage without a model is not part of the plan; its columns are
    null. Models see the content whole, or its first ``max_bytes`` bytes; a failed
    call leaves its columns null and is no error of the page. Split the result with ``split_errors``.
    """
    flagged = pages.withColumn("_md", detect_markdown("url", "content_type", "body"))
    converted = flagged.withColumn(
        "_html", html_to_markdown(F.when(~F.col("_md"), F.coalesce("body", F.lit(""))))
    )
    title = F.when(F.col("_md"), markdown_title("body")).otherwise(F.col("_html.title"))
    content = F.when(F.col("_md"), F.col("body")).otherwise(F.col("_html.markdown"))
    documents = converted.select(
        document_id("url").alias("id"),
        "url",
        title_or_url(title, "url").alias("title"),
        content.alias("content"),
        "content_type",
        "scraped_at",
        F.col("_html.error").alias("error"),
    )
    if make_text_model is not None:
        documents = enrich(documents, make_text_model, max_bytes=max_bytes)
    if make_embedding_model is not None:
        documents = embed(documents, make_embedding_model, max_bytes=max_bytes)
    for name in OPTIONAL_FIELDS:
        if name not in documents.columns:
            documents = documents.withColumn(
                name, F.lit(None).cast(DOCUMENT_SCHEMA[name].dataType)
            )
    if dims is not None:
        checked = check_dims(documents.drop("embedding_error"), dims)
        documents = checked.withColumn("error", F.coalesce("error", "embedding_error"))
    return documents.select(*DOCUMENT_SCHEMA.names, "error")
