"""Search, nearest neighbours, hybrid search and lookup."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import html_title
from ..operators.analysis import ENGLISH, STANDARD, build_index, build_postings
from ..operators.bm25 import (
    _top,
    bm25_scores,
    join_documents,
    search,
    search_index,
    search_many,
)
from ..operators.hybrid import hybrid_search, hybrid_search_many
from ..operators.lookup import get_document, get_many
from ..operators.vectors import (
    build_vector_index,
    knn,
    knn_approx,
    knn_many,
    open_vector_index,
    write_vector_index,
)
from ..sinks import hits_preview, hits_to_json, open_index, write_index
from ..sinks.versions import path_exists
from . import registry as r
from .registry import documents_table, pages_table, query, table
from .stemming_sql import english_words, stems
from .text import sql_html_title

TEXT_QUERY = "oner enat reth the oner"
STANDARD_CONTENT = {"content": STANDARD}


def _stored_index(spark, sf_dir):
    """The index of the documents, written at its first use in the application."""
    root = r.stored(spark, f"index of {sf_dir}")
    if not path_exists(spark, f"{root}/done"):
        write_index(build_index(documents_table(spark, sf_dir), STANDARD_CONTENT), root)
        spark.range(0).write.mode("overwrite").parquet(f"{root}/done")
    return open_index(spark, root)


def _sql_bm25(fields: dict[str, tuple[str, str, float]], query_terms: str) -> str:
    """CTEs ``scores(query_id, id, score)``.

    ``fields`` maps a name to (table expression, text expression, boost);
    ``query_terms`` is a relation ``query_id, term, qtf``.
    """
    tokens = " UNION ALL ".join(
        f"SELECT '{name}' AS field, {boost} AS boost, id, {r.words(text)} AS words FROM {source}"
        for name, (source, text, boost) in fields.items()
    )
    return f"""
    tokens AS ({tokens}),
    stats AS (
        SELECT field, count(*) AS n, avg(len(words)) AS avg_len FROM tokens
        WHERE len(words) > 0 GROUP BY field
    ),
    qterms AS ({query_terms}),
    tf AS (
        SELECT field, boost, id, term, count(*) AS tf, any_value(n_words) AS n_words
        FROM (SELECT field, boost, id, len(words) AS n_words, unnest(words) AS term FROM tokens)
        WHERE term IN (SELECT term FROM qterms)
        GROUP BY ALL
    ),
    df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY ALL),
    per_field AS (
        SELECT query_id, id, field, any_value(boost) * sum(
            qtf * ln(1 + (n - df + 0.5) / (df + 0.5))
            * 2.2 * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * n_words / avg_len))) AS score
        FROM tf JOIN df USING (field, term) JOIN stats USING (field) JOIN qterms USING (term)
        GROUP BY query_id, id, field
    ),
    scores AS (
        SELECT query_id, id, round(max(score), 9) AS score FROM per_field GROUP BY query_id, id
    )"""


def _sql_query_terms(text: str) -> str:
    return (
        f"SELECT 0 AS query_id, term, count(*) AS qtf FROM "
        f"(SELECT unnest({r.words(repr(text))}) AS term) GROUP BY term"
    )


_DOCS = "(SELECT doc_id AS id, text FROM documents)"
_RANKED = (
    "SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM scores"
)
_ONE_FIELD = _sql_bm25({"content": (_DOCS, "text", 1.0)}, _sql_query_terms(TEXT_QUERY))


def _scores(hits):
    return hits.select("rank", "id", F.round("score", 6).alias("score"))


@query(
    f"""
    WITH {_ONE_FIELD}, ranked AS ({_RANKED})
    SELECT rank, ranked.id, round(score, 6) AS score, md5(text) AS content
    FROM ranked JOIN {_DOCS} d USING (id) WHERE rank <= 10
    """
)
def search_bm25(spark, sf_dir):
    documents = documents_table(spark, sf_dir)
    hits = search(documents, TEXT_QUERY, 10, STANDARD_CONTENT)
    return hits.select(
        "rank", "id", F.round("score", 6).alias("score"), F.md5("content").alias("content")
    )


@query(
    f"""
    WITH {_ONE_FIELD}
    SELECT d.id, round(score, 6) AS score FROM {_DOCS} d LEFT JOIN scores USING (id)
    """
)
def bm25_all_scores(spark, sf_dir):
    scored = bm25_scores(documents_table(spark, sf_dir), TEXT_QUERY, STANDARD_CONTENT)
    return scored.select("id", F.round("score", 6).alias("score"))


@query(
    f"""
    WITH {_ONE_FIELD}, ranked AS ({_RANKED})
    SELECT rank, id, round(score, 6) AS score FROM ranked WHERE rank <= 10
    """,
    name="search_index",
)
def search_by_index(spark, sf_dir):
    return _scores(search_index(_stored_index(spark, sf_dir), TEXT_QUERY, 10))


_STRIPPED = (
    "regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), "
    "'(?s)<[^>]*>', ' ', 'g')"
)
_PAGE_FIELDS = f"""(
    SELECT page_id AS id, {sql_html_title('html')} AS title, {_STRIPPED} AS content,
           replace(url, '/', chr(10)) AS tags
    FROM pages)"""
PAGE_QUERY = "en therhan the 2 example"


@query(
    f"""
    WITH {_sql_bm25(
        {"content": (_PAGE_FIELDS, "content", 1.0), "title": (_PAGE_FIELDS, "title", 1.0),
         "tags": (_PAGE_FIELDS, "tags", 2.0)},
        _sql_query_terms(PAGE_QUERY))}, ranked AS ({_RANKED})
    SELECT rank, id, round(score, 6) AS score FROM ranked WHERE rank <= 50
    """
)
def search_multi_field(spark, sf_dir):
    body = F.regexp_replace("body", r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    documents = pages_table(spark, sf_dir).select(
        F.col("page_id").alias("id"),
        html_title("body").alias("title"),
        F.regexp_replace(body, r"(?s)<[^>]*>", " ").alias("content"),
        F.split("url", "/").alias("tags"),
    )
    fields = {"content": STANDARD, "title": STANDARD, "tags": STANDARD}
    return _scores(search(documents, PAGE_QUERY, 50, fields))


_BATCH_TERMS = f"""
    SELECT query_id, term, count(*) AS qtf
    FROM (SELECT item_id AS query_id, unnest({r.words('text')}) AS term FROM benchmark)
    GROUP BY ALL
"""


def _batch_queries(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


@query(
    f"""
    WITH {_sql_bm25({"content": (_DOCS, "text", 1.0)}, _BATCH_TERMS)}, ranked AS ({_RANKED})
    SELECT query_id, rank, id, round(score, 6) AS score FROM ranked WHERE rank <= 10
    """,
    name="search_many",
)
def search_batch(spark, sf_dir):
    index = _stored_index(spark, sf_dir)
    hits = search_many(index, _batch_queries(spark, sf_dir), 10)
    return hits.select("query_id", "rank", "id", F.round("score", 6).alias("score"))


ENGLISH_QUERY = "entions oners the"
_ENGLISH = f"""
    words AS MATERIALIZED (SELECT doc_id AS id, {english_words('text')} AS w FROM documents),
    asked AS (SELECT unnest({english_words(repr(ENGLISH_QUERY))}) AS word),
    vocabulary AS (SELECT unnest(w) AS word FROM words UNION SELECT word FROM asked),
    {stems('vocabulary')},
    stats AS (SELECT count(*) AS n, avg(len(w)) AS avg_len FROM words WHERE len(w) > 0),
    qterms AS (SELECT stem, count(*) AS qtf FROM asked JOIN stems USING (word) GROUP BY stem),
    tf AS (
        SELECT id, stem, count(*) AS tf, any_value(n_words) AS n_words
        FROM (SELECT id, len(w) AS n_words, unnest(w) AS word FROM words) JOIN stems USING (word)
        WHERE stem IN (SELECT stem FROM qterms) GROUP BY id, stem
    ),
    df AS (SELECT stem, count(*) AS df FROM tf GROUP BY stem),
    scores AS (
        SELECT id, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5))
            * 2.2 * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * n_words / avg_len))), 9) AS score
        FROM tf JOIN df USING (stem) JOIN qterms USING (stem), stats GROUP BY id
    ),
    ranked AS (
        SELECT *, CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS rank FROM scores
    )"""


@query(
    f"""
    WITH {_ENGLISH}
    SELECT rank, id, round(score, 6) AS score FROM ranked WHERE rank <= 100
    """
)
def search_english(spark, sf_dir):
    return _scores(search(documents_table(spark, sf_dir), ENGLISH_QUERY, 100))


@query(
    f"""
    WITH words AS MATERIALIZED (SELECT doc_id AS id, {english_words('text')} AS w FROM documents),
    vocabulary AS (SELECT DISTINCT unnest(w) AS word FROM words),
    {stems('vocabulary')}
    SELECT id, md5(string_agg(stem || ' ' || tf, ',' ORDER BY stem)) AS terms,
           any_value(n_words) AS len
    FROM (
        SELECT id, stem, count(*) AS tf, any_value(n_words) AS n_words
        FROM (SELECT id, len(w) AS n_words, unnest(w) AS word FROM words) JOIN stems USING (word)
        GROUP BY id, stem
    ) GROUP BY id
    """
)
def postings_english(spark, sf_dir):
    """The postings of the English analyzer, as a digest of each document's terms."""
    rows = build_postings(documents_table(spark, sf_dir), {"content": ENGLISH})
    # Of one document, so bounded by its text.
    terms = F.array_sort(F.collect_list(F.struct("term", "tf")))
    joined = F.array_join(F.transform(terms, lambda t: F.concat_ws(" ", t["term"], t["tf"])), ",")
    return rows.groupBy("id").agg(F.md5(joined).alias("terms"), F.max("len").cast("bigint").alias("len"))


def _sql_cosine(a: str, b: str) -> str:
    return f"round(list_cosine_similarity({a}::DOUBLE[], {b}::DOUBLE[]), 9)"


# The mean of all vectors, as one list.
_MEAN = """
    SELECT list(x ORDER BY i) AS v FROM (
        SELECT i, round(avg(x), 9) AS x
        FROM (SELECT unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS i
              FROM embeddings)
        GROUP BY i)
"""
_MEAN_PER_LABEL = """
    SELECT label AS query_id, list(x ORDER BY i) AS v FROM (
        SELECT label, i, round(avg(x), 9) AS x
        FROM (SELECT label, unnest(embedding::DOUBLE[]) AS x,
                     generate_subscripts(embedding, 1) AS i FROM embeddings)
        GROUP BY label, i)
    GROUP BY label
"""


def _means(vectors, *keys):
    """Mean vector per group; positions are averaged with partial aggregation."""
    exploded = vectors.select(*keys, F.posexplode("embedding").alias("i", "x"))
    means = exploded.groupBy(*keys, "i").agg(F.round(F.avg("x"), 9).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    vector = F.transform(ordered, lambda e: e["x"]).alias("query_embedding")
    return means.groupBy(*keys).agg(vector)


def _mean_vector(spark, sf_dir):
    return _means(table(spark, sf_dir, "embeddings")).first()["query_embedding"]


@query(
    f"""
    WITH q AS ({_MEAN}), s AS (SELECT vec_id AS id, {_sql_cosine('embedding', 'v')} AS score FROM embeddings, q)
    SELECT CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS rank, id, round(score, 6) AS score
    FROM s QUALIFY rank <= 20
    """,
    name="knn",
)
def knn_exact(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return _scores(knn(vectors, _mean_vector(spark, sf_dir), 20, id_col="vec_id"))


@query(
    f"""
    WITH q AS ({_MEAN_PER_LABEL}),
    s AS (SELECT query_id, vec_id AS id, {_sql_cosine('embedding', 'v')} AS score FROM embeddings, q)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank,
           id, round(score, 6) AS score
    FROM s QUALIFY rank <= 10
    """,
    name="knn_many",
)
def knn_batch(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    queries = _means(vectors, "label").withColumnRenamed("label", "query_id")
    hits = knn_many(vectors, queries, 10, id_col="vec_id")
    return hits.select("query_id", "rank", "id", F.round("score", 6).alias("score"))


@query(
    f"""
    WITH q AS ({_MEAN}), s AS (SELECT vec_id AS id, {_sql_cosine('embedding', 'v')} AS score FROM embeddings, q)
    SELECT CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS rank,
           true AS is_exact, true AS in_order, true AS recall_is_high
    FROM s QUALIFY rank <= 50
    """,
    name="knn_approx",
)
def knn_by_cells(spark, sf_dir):
    """Fifty neighbours from the stored cells: whole, exact, in order, and nine of ten
    of them among the true ones."""
    vectors = table(spark, sf_dir, "embeddings")
    root = r.stored(spark, f"cells with reach of {sf_dir}")
    if not path_exists(spark, f"{root}/cells/_SUCCESS"):
        write_vector_index(build_vector_index(vectors, 64, id_col="vec_id"), root)
    vector = _mean_vector(spark, sf_dir)
    found = knn_approx(open_vector_index(spark, root), vector, 50)
    true = knn(vectors, vector, 50, id_col="vec_id").select("id", F.lit(1).alias("hit"))
    dot = F.aggregate(
        F.zip_with("embedding", F.array(*map(F.lit, vector)), lambda x, y: x.cast("double") * y),
        F.lit(0.0),
        lambda a, b: a + b,
    )
    norm = lambda x: F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, b: a + b * b.cast("double")))
    cosine = dot / norm(F.col("embedding")) / F.lit(math.sqrt(sum(x * x for x in vector)))
    checked = (
        found.join(vectors.select(F.col("vec_id").alias("id"), cosine.alias("cosine")), "id")
        .join(true, "id", "left")
    )
    everything = Window.partitionBy(F.lit(0))
    above = F.lag("score").over(everything.orderBy("rank"))
    return checked.select(
        "rank",
        (F.abs(F.col("score") - F.col("cosine")) < 1e-8).alias("is_exact"),
        (above.isNull() | (above >= F.col("score"))).alias("in_order"),
        (F.count("hit").over(everything) >= 0.9 * F.count(F.lit(1)).over(everything)).alias(
            "recall_is_high"
        ),
    )


def _documents_with_vectors(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return documents_table(spark, sf_dir).join(vectors, "id", "left")


HYBRID_LIMIT = 100


@query(
    f"""
    WITH {_ONE_FIELD}, text_arm AS ({_RANKED}),
    q AS ({_MEAN}),
    s AS (SELECT vec_id AS id, {_sql_cosine('embedding', 'v')} AS score
          FROM embeddings JOIN documents ON doc_id = vec_id, q),
    vector_arm AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank FROM s),
    arms AS (
        SELECT id, rank FROM text_arm WHERE rank <= {HYBRID_LIMIT}
        UNION ALL SELECT id, rank FROM vector_arm WHERE rank <= {HYBRID_LIMIT}
    ),
    fused AS (SELECT id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM arms GROUP BY id)
    SELECT CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS rank, id, round(score, 6) AS score
    FROM fused QUALIFY rank <= {HYBRID_LIMIT}
    """,
    name="hybrid_search",
)
def hybrid(spark, sf_dir):
    documents = _documents_with_vectors(spark, sf_dir)
    vector = _mean_vector(spark, sf_dir)
    return _scores(hybrid_search(documents, TEXT_QUERY, vector, HYBRID_LIMIT, STANDARD_CONTENT))


@query(
    f"""
    WITH {_sql_bm25(
        {"content": (_DOCS, "text", 1.0), "summary": ("(SELECT doc_id AS id, source FROM documents)", "source", 1.0)},
        _sql_query_terms("oner src7"))}, ranked AS ({_RANKED})
    SELECT rank, id, round(score, 6) AS score FROM ranked WHERE rank <= {HYBRID_LIMIT}
    """
)
def hybrid_fallback(spark, sf_dir):
    documents = _documents_with_vectors(spark, sf_dir).withColumnRenamed("source", "summary")
    fields = {"content": STANDARD, "summary": STANDARD}
    return _scores(hybrid_search(documents, "oner src7", None, HYBRID_LIMIT, fields))


@query(
    f"""
    WITH {_sql_bm25({"content": (_DOCS, "text", 1.0)}, _BATCH_TERMS)}, text_arm AS ({_RANKED}),
    q AS ({_MEAN_PER_LABEL}),
    s AS (SELECT query_id, vec_id AS id, {_sql_cosine('embedding', 'v')} AS score
          FROM embeddings JOIN documents ON doc_id = vec_id, q
          WHERE query_id IN (SELECT item_id FROM benchmark)),
    vector_arm AS (
        SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
        FROM s
    ),
    arms AS (
        SELECT query_id, id, rank FROM text_arm
        WHERE rank <= 50 AND query_id IN (SELECT query_id FROM q)
        UNION ALL SELECT query_id, id, rank FROM vector_arm WHERE rank <= 50
    ),
    fused AS (
        SELECT query_id, id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM arms GROUP BY ALL
        UNION ALL SELECT query_id, id, score FROM text_arm
        WHERE rank <= 50 AND query_id NOT IN (SELECT query_id FROM q)
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank,
           id, round(score, 6) AS score
    FROM fused QUALIFY rank <= 50
    """,
    name="hybrid_search_many",
)
def hybrid_batch(spark, sf_dir):
    """Queries whose id is a label have a vector, the others fall back to text."""
    documents = _documents_with_vectors(spark, sf_dir)
    means = _means(table(spark, sf_dir, "embeddings"), "label")
    queries = _batch_queries(spark, sf_dir).join(
        means.withColumnRenamed("label", "query_id"), "query_id", "left"
    )
    index = _stored_index(spark, sf_dir)
    hits = hybrid_search_many(index, documents, queries, 50)
    return hits.select("query_id", "rank", "id", F.round("score", 6).alias("score"))


@query("SELECT doc_id AS id, md5(text) AS content, lang FROM documents WHERE doc_id = 42", name="get_document")
def document_by_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"), "lang"
    )
    return get_document(documents, 42).select("id", F.md5("content").alias("content"), "lang")


@query(
    """
    SELECT ids.id, text IS NOT NULL AS found, md5(text) AS content
    FROM (SELECT doc_id * 2 AS id FROM labels UNION SELECT -1) ids
    LEFT JOIN documents ON doc_id = ids.id
    """,
    name="get_many",
)
def documents_by_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").select((F.col("doc_id") * 2).alias("id"))
    ids = ids.unionByName(spark.range(1).select(F.lit(-1).cast("bigint").alias("id")))
    found = get_many(table(spark, sf_dir, "documents"), ids, id_col="doc_id")
    return found.select("id", "found", F.md5("text").alias("content"))


def _full_hits(spark, sf_dir):
    """Hits that carry every document field; half of them without the optional ones."""
    documents = documents_table(spark, sf_dir).select(
        F.col("id").cast("string").alias("id"),
        F.concat(F.lit("https://docs.example.org/"), "id").alias("url"),
        F.concat(F.lit("Title "), "id").alias("title"),
        "content",
        F.when(F.col("id") % 2 == 0, F.array("source", "lang"))
        .otherwise(F.array().cast("array<string>"))
        .alias("tags"),
        F.when(F.col("id") % 2 == 0, F.col("source")).otherwise("").alias("summary"),
        F.lit("").alias("content_type"),
    )
    scored = bm25_scores(documents, TEXT_QUERY, STANDARD_CONTENT)
    return join_documents(_top(scored, 40), documents, n_hits=40)


_TEXT_IDS = _sql_bm25(
    {"content": ("(SELECT doc_id::VARCHAR AS id, text FROM documents)", "text", 1.0)},
    _sql_query_terms(TEXT_QUERY),
)
_HIT_ROWS = f"""
    WITH {_TEXT_IDS}, ranked AS ({_RANKED}),
    hits AS (SELECT rank, ranked.id, d.* FROM ranked JOIN documents d ON d.doc_id::VARCHAR = ranked.id
             WHERE rank <= 40)
"""


@query(
    f"""
    {_HIT_ROWS}
    SELECT rank, id, 'https://docs.example.org/' || id AS url, 'Title ' || id AS title,
           md5(text) AS content, '' AS content_type,
           CASE WHEN doc_id % 2 = 0 THEN '["' || source || '","' || lang || '"]' END AS tags,
           CASE WHEN doc_id % 2 = 0 THEN source END AS summary,
           CASE WHEN doc_id % 2 = 0 THEN 'id url title content content_type tags summary'
                ELSE 'id url title content content_type' END AS keys
    FROM hits
    """
)
def hits_json(spark, sf_dir):
    rows = hits_to_json(_full_hits(spark, sf_dir), keep=["rank"])

    def value(name):
        return F.get_json_object("document", f"$.{name}")

    return rows.select(
        "rank",
        value("id").alias("id"),
        value("url").alias("url"),
        value("title").alias("title"),
        F.md5(value("content")).alias("content"),
        value("content_type").alias("content_type"),
        value("tags").alias("tags"),
        value("summary").alias("summary"),
        F.array_join(F.json_object_keys("document"), " ").alias("keys"),
    )


@query(
    f"""
    {_HIT_ROWS}
    SELECT rank, 'Title ' || id AS title, 'https://docs.example.org/' || id AS url, id,
           strlen(text) > 500 AS is_cut,
           CASE WHEN strlen(text) > 500 AND strlen(text) = length(text)
                THEN md5(substr(text, 1, 500) || '...')
                WHEN strlen(text) <= 500 THEN md5(text) END AS ascii_content
    FROM hits
    """,
    name="hits_preview",
)
def hits_text(spark, sf_dir):
    full = _full_hits(spark, sf_dir)
    shown = hits_preview(full)
    sizes = full.select(
        "id",
        (F.octet_length("content") > 500).alias("is_cut"),
        (
            (F.octet_length("content") <= 500)
            | (F.octet_length("content") == F.length("content"))
        ).alias("_comparable"),
    )
    return shown.join(sizes, "id").select(
        "rank",
        "title",
        "url",
        "id",
        "is_cut",
        F.when(F.col("_comparable"), F.md5("content")).alias("ascii_content"),
    )
