"""Hybrid search: reciprocal rank fusion of BM25 and nearest neighbours."""

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .analysis import CorpusIndex
from .bm25 import (
    BOOSTS,
    DEFAULT_LIMIT,
    SCORE_DIGITS,
    _top,
    bm25_scores,
    check_limit,
    join_documents,
    present_fields,
    score_many,
    search,
    top_per_query,
)
from .vectors import knn, knn_many

RRF_CONSTANT = 60
HYBRID_FIELDS = ("content", "title")


def fuse_ranks(
    arms: list[DataFrame], keys: list[str], rrf_constant: int = RRF_CONSTANT
) -> DataFrame:
    """Sum of ``1 / (constant + rank)`` over the arms; their order is irrelevant."""
    ranked = [arm.select(*keys, F.col("rank")) for arm in arms]
    united = ranked[0]
    for arm in ranked[1:]:
        united = united.unionByName(arm)
    share = 1.0 / (F.lit(rrf_constant) + F.col("rank"))
    return united.groupBy(*keys).agg(F.round(F.sum(share), SCORE_DIGITS).alias("score"))


def hybrid_fields(fields: dict[str, str]) -> dict[str, str]:
    return {f: a for f, a in fields.items() if f in HYBRID_FIELDS}


def hybrid_search(
    documents: DataFrame,
    query: str,
    query_embedding: Sequence[float] | None,
    limit: int = DEFAULT_LIMIT,
    fields: dict[str, str] | None = None,
    window: int | None = None,
    rrf_constant: int = RRF_CONSTANT,
    id_col: str = "id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Fused best ``limit`` documents; without a vector plain BM25 over all fields.

    The text arm uses content and title only and no boosts. Each arm is cut to
    ``window`` (by default the limit) before fusion.
    """
    check_limit(limit)
    if query_embedding is None:
        return search(documents, query, limit, fields, id_col=id_col)
    window = limit if window is None else window
    chosen = hybrid_fields(fields or present_fields(documents))
    text = _top(bm25_scores(documents, query, chosen, None, id_col), window)
    near = knn(documents, query_embedding, window, id_col, vector_col)
    fused = _top(fuse_ranks([text, near], ["id"], rrf_constant), limit)
    return join_documents(fused, documents, id_col, limit)


def hybrid_search_many(
    index: CorpusIndex,
    documents: DataFrame,
    queries: DataFrame,
    limit: int = DEFAULT_LIMIT,
    window: int | None = None,
    rrf_constant: int = RRF_CONSTANT,
    id_col: str = "id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, id, score`` per query; rows without a vector fall back."""
    check_limit(limit)
    window = limit if window is None else window
    with_vector = queries.where(F.col("query_embedding").isNotNull())
    without = queries.where(F.col("query_embedding").isNull())
    in_use = F.col("field").isin(*HYBRID_FIELDS)
    narrow = replace(
        index,
        postings=index.postings.where(in_use),
        term_stats=index.term_stats.where(in_use),
        field_stats=index.field_stats.where(in_use),
        fields=hybrid_fields(index.fields),
    )
    text = top_per_query(score_many(narrow, with_vector), window)
    near = knn_many(documents, with_vector, window, id_col, vector_col)
    fused = top_per_query(fuse_ranks([text, near], ["query_id", "id"], rrf_constant), limit)
    plain = top_per_query(score_many(index, without, BOOSTS), limit)
    columns = ["query_id", "rank", "id", "score"]
    return fused.select(*columns).unionByName(plain.select(*columns))
