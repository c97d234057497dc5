"""Result rows as JSON or as a short text preview."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import truncate_bytes
from ..schemas import DOCUMENT_SCHEMA

PREVIEW_BYTES = 500  # Fixed value: bytes of content shown per hit.


def _given(name: str, columns: list[str]) -> Column:
    """Optional fields are left out of the JSON when empty; others become ''."""
    field = DOCUMENT_SCHEMA[name]
    value = F.col(name) if name in columns else F.lit(None).cast(field.dataType)
    if name in ("tags", "embedding"):
        return F.when(F.size(value) > 0, value)
    if name == "summary":
        return F.nullif(value, F.lit(""))
    return value if name == "scraped_at" else F.coalesce(value, F.lit(""))


def hits_to_json(hits: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One ``document`` JSON string per hit, next to the columns named in ``keep``."""
    if keep is None:
        keep = [c for c in hits.columns if c not in DOCUMENT_SCHEMA.names]
    document = F.struct(*[_given(n, hits.columns).alias(n) for n in DOCUMENT_SCHEMA.names])
    return hits.select(*keep, F.to_json(document).alias("document"))


def hits_preview(hits: DataFrame, limit: int = PREVIEW_BYTES) -> DataFrame:
    """Rank, title, URL, id and the first bytes of the content of every hit."""
    content = F.col("content")
    cut = F.concat(truncate_bytes(content, limit), F.lit("..."))
    leading = [c for c in ("query_id", "rank") if c in hits.columns]
    return hits.select(
        *leading,
        "title",
        "url",
        "id",
        F.when(F.octet_length(content) > limit, cut).otherwise(content).alias("content"),
    )
