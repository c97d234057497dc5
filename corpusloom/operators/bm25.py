"""BM25 search: one query over documents, a table of queries over an index."""

import functools
import operator
from collections import Counter
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stemming import stem_prefix, stem_words
from ..plans import hot_keys, is_bounded, salted_join
from .analysis import (
    ENGLISH,
    CorpusIndex,
    _length_totals,
    analyze,
    analyze_text,
    present_fields,
    term_counts,
    tokenize,
)

K1 = 1.2
B = 0.75
DEFAULT_LIMIT = 10
BOOSTS = {"content": 1.0, "title": 1.0, "tags": 2.0, "summary": 1.0}
# Scores are rounded before they are compared: sums of doubles depend on the order
# of addition, and equal documents must tie.
SCORE_DIGITS = 9
BROADCAST_HITS = 100_000
#: Rows of query, term and document that a task of :func:`score_many` sums up, about.
TASK_ROWS = 4_000_000


def check_limit(limit: int) -> int:
    if limit < 0:
        raise ValueError("limit must not be negative")
    return limit


def bm25_idf(df: Column, doc_count: Column) -> Column:
    return F.ln(1 + (doc_count - df + 0.5) / (df + 0.5))


def bm25_weight(
    tf: Column, length: Column, avg_len: Column, k1: float = K1, b: float = B
) -> Column:
    norm = k1 * (1 - b + b * length / avg_len)
    return (k1 + 1) * tf / (tf + norm)


def _top(scored: DataFrame, limit: int) -> DataFrame:
    """Best ``limit`` scored rows by score, then id, with their rank."""
    top = scored.orderBy(F.desc_nulls_last("score"), "id").limit(limit)
    top = top.where(F.col("score").isNotNull())
    window = Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), "id")
    return top.withColumn("rank", F.row_number().over(window))


def join_documents(
    hits: DataFrame, documents: DataFrame, id_col: str = "id", n_hits: int | None = None
) -> DataFrame:
    """Late materialization: full rows for the ranked ids only.

    ``n_hits`` is a bound on the hits (the limit of one query), checked before they
    are broadcast; without it they are the hits of a table of queries.
    """
    columns = [c for c in documents.columns if c not in hits.columns or c == id_col]
    rows = documents.select(*columns)
    if id_col != "id":
        rows = rows.withColumnRenamed(id_col, "id")
    if n_hits is not None and n_hits <= BROADCAST_HITS:
        joined = rows.join(F.broadcast(hits), "id")
    elif n_hits is not None:
        joined = rows.join(hits, "id")
    else:
        # A document may be a hit of very many queries.
        joined = salted_join(hits, rows, ["id"], ["query_id"])
    return joined.select(*hits.columns, *[c for c in rows.columns if c != "id"])


def bm25_scores(
    documents: DataFrame,
    query: str,
    fields: dict[str, str] | None = None,
    boosts: dict[str, float] | None = None,
    id_col: str = "id",
    k1: float = K1,
    b: float = B,
) -> DataFrame:
    """``id, score`` of every document; the score is null where no term matches.

    Two passes over the text fields and no shuffle of documents: one aggregate
    gives a single row (count and length per field, frequency per query term),
    whose numbers become literals of a projection that scores inside each row. With
    English fields a pass before them finds the words of the query's stems.
    """
    fields = fields or present_fields(documents)
    boosts = boosts or {}
    spark = documents.sparkSession
    analyzed = {a: analyze_text(spark, query, a) for a in set(fields.values())}
    tokens = tokenize(documents, fields, id_col)
    forms = word_forms(tokens, fields, set(analyzed.get(ENGLISH, ())))
    # Per field and term: how often it is asked for, and its words.
    terms = {
        f: [
            (repeat, forms.get(term, []) if a == ENGLISH else [term])
            for term, repeat in Counter(analyzed[a]).items()
        ]
        for f, a in fields.items()
    }
    terms = {f: [(n, words) for n, words in found if words] for f, found in terms.items()}
    kept = tokens.select(
        "id",
        *[F.size(f).alias(f"{f}_size") for f in fields],
        *[_keep(f, [w for _, words in terms[f] for w in words]).alias(f) for f in fields if terms[f]],
    )
    frequencies = [
        F.count_if(F.size(_keep(f, words)) > 0).alias(f"{f}_df_{n}")
        for f in fields
        for n, (_, words) in enumerate(terms[f])
    ]
    if not frequencies:
        return kept.select("id", F.lit(None).cast("double").alias("score"))
    stats = kept.agg(
        *_length_totals(fields, lambda f: F.col(f"{f}_size")), *frequencies
    ).first()

    def field_score(field: str) -> Column:
        docs = stats[f"{field}_docs"]
        avg_len = F.lit(float(stats[f"{field}_len"] / docs))
        length = F.col(f"{field}_size")
        parts = []
        for n, (repeat, words) in enumerate(terms[field]):
            df = stats[f"{field}_df_{n}"]
            if df:
                tf = F.size(_keep(field, words))
                idf = repeat * bm25_idf(F.lit(df), F.lit(docs))
                parts.append(idf * bm25_weight(tf, length, avg_len, k1, b))
        total = sum(parts, F.lit(0.0))
        return total * float(boosts.get(field, 1.0))

    live = [f for f in fields if stats[f"{f}_docs"] and terms[f]]
    if not live:
        return kept.select("id", F.lit(None).cast("double").alias("score"))
    # No filter on matches here: pushed below the projection it would tokenize
    # every document a second time.
    matched = [F.when(F.size(f) > 0, field_score(f)) for f in live]
    best = F.array_max(F.array(*matched))
    return kept.select("id", F.round(best, SCORE_DIGITS).alias("score"))


def word_forms(tokens: DataFrame, fields: dict[str, str], stems: set[str]) -> dict[str, list[str]]:
    """The words of the English fields that have one of the query's ``stems``.

    Only distinct words that begin like one of the stems are stemmed. A stem has few
    words: what may follow it is made of the analyzer's suffixes.
    """
    english = [f for f, a in fields.items() if a == ENGLISH]
    if not english or not stems:
        return {}
    starts = sorted({stem_prefix(stem) for stem in stems})

    def near(word: Column) -> Column:
        return functools.reduce(operator.or_, [word.startswith(start) for start in starts])

    found = F.array_distinct(F.filter(F.flatten(F.array(*english)), near))
    # An outer explode: for an inner one the words would be made twice.
    words = tokens.select(F.explode_outer(found).alias("word")).where("word is not null").distinct()
    stemmed = words.withColumn("stem", stem_words("word")).where(F.col("stem").isin(*stems))
    forms: dict[str, list[str]] = {}
    for word, stem in sorted(stemmed.collect()):
        forms.setdefault(stem, []).append(word)
    return forms


def _keep(field: str, terms: list[str]) -> Column:
    return F.filter(field, lambda token: token.isin(*terms))


def search(
    documents: DataFrame,
    query: str,
    limit: int = DEFAULT_LIMIT,
    fields: dict[str, str] | None = None,
    boosts: dict[str, float] | None = None,
    id_col: str = "id",
    k1: float = K1,
    b: float = B,
) -> DataFrame:
    """Best ``limit`` documents for a query, with ``rank`` and ``score``."""
    check_limit(limit)
    boosts = BOOSTS if boosts is None else boosts
    scored = bm25_scores(documents, query, fields, boosts, id_col, k1, b)
    return join_documents(_top(scored, limit), documents, id_col, limit)


def query_terms(queries: DataFrame, fields: dict[str, str]) -> DataFrame:
    """``query_id, field, term, qtf``: each query analyzed as each field is."""
    tokens = queries.select(
        "query_id", *[analyze("query", a).alias(f) for f, a in fields.items()]
    )

    def entries_of(field: str) -> Column:
        return F.transform(
            term_counts(F.col(field)),
            lambda e: F.struct(
                F.lit(field).alias("field"), e["term"].alias("term"), e["tf"].alias("qtf")
            ),
        )

    entries = [entries_of(f) for f in fields]
    return tokens.select("query_id", F.inline(F.flatten(F.array(*entries))))


def score_many(
    index: CorpusIndex,
    queries: DataFrame,
    boosts: dict[str, float] | None = None,
    k1: float = K1,
    b: float = B,
    bounded: bool = False,
) -> DataFrame:
    """``query_id, id, score`` for every matching pair of query and document.

    The weighted query terms are broadcast when their measured size allows; the
    postings they ask for are then dealt by document, so that pairs of query and
    document are made and summed up in one task and never shuffled. Otherwise they
    meet the postings in a shuffle join in which the postings of very frequent terms
    are salted by document id. ``bounded`` says that the queries come from the driver
    and need no measuring.
    """
    boosts = boosts or {}
    terms = query_terms(queries, index.fields)
    small = bounded or is_bounded(terms)
    distinct_terms = terms.select("field", "term").distinct()
    if small:
        distinct_terms = F.broadcast(distinct_terms)
    stats = index.term_stats.join(distinct_terms, ["field", "term"], "left_semi")
    weights = (
        terms.join(stats, ["field", "term"])
        .join(F.broadcast(index.field_stats), "field")  # one row per field
        .select(
            "query_id",
            "field",
            "term",
            (F.col("qtf") * bm25_idf(F.col("df"), F.col("doc_count"))).alias("weight"),
            "avg_len",
        )
    )
    keys = ["field", "term"]
    if bounded:
        matched = index.postings.join(F.broadcast(weights), keys)
    elif small:
        asked = terms.join(stats, keys).agg(F.sum("df")).first()[0] or 0
        held = index.postings.join(distinct_terms, keys, "left_semi")
        n_tasks = max(held.sparkSession.sparkContext.defaultParallelism, -(-asked // TASK_ROWS))
        matched = held.repartition(n_tasks, "id").join(F.broadcast(weights), keys)
    else:
        hot = hot_keys(stats, keys, "df")
        matched = salted_join(index.postings, weights, keys, ["id"], hot)
    part = F.col("weight") * bm25_weight(F.col("tf"), F.col("len"), F.col("avg_len"), k1, b)
    # One column per field instead of one group per field: a single shuffle on
    # (query, document), with partial sums before it.
    sums = [
        (F.sum(F.when(F.col("field") == f, part)) * float(boosts.get(f, 1.0))).alias(f)
        for f in index.fields
    ]
    per_document = matched.groupBy("query_id", "id").agg(*sums)
    best = F.array_max(F.array(*[F.col(f) for f in index.fields]))
    return per_document.select("query_id", "id", F.round(best, SCORE_DIGITS).alias("score"))


def top_per_query(scored: DataFrame, limit: int) -> DataFrame:
    """Ranks per query; the filter on the rank also prunes before the shuffle."""
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= limit)


def search_many(
    index: CorpusIndex,
    queries: DataFrame,
    limit: int = DEFAULT_LIMIT,
    boosts: dict[str, float] | None = None,
    documents: DataFrame | None = None,
    k1: float = K1,
    b: float = B,
    bounded: bool = False,
) -> DataFrame:
    """``query_id, rank, id, score`` for every row of ``queries``.

    A row without text has no terms and so no hits. With ``documents`` the document
    columns are joined to the hits.
    """
    check_limit(limit)
    boosts = BOOSTS if boosts is None else boosts
    hits = top_per_query(score_many(index, queries, boosts, k1, b, bounded), limit)
    hits = hits.select("query_id", "rank", "id", "score")
    return hits if documents is None else join_documents(hits, documents)


def search_index(
    index: CorpusIndex,
    query: str,
    limit: int = DEFAULT_LIMIT,
    boosts: dict[str, float] | None = None,
    documents: DataFrame | None = None,
) -> DataFrame:
    """One query over a stored index.

    The terms reach the postings scan as literals, so only the row groups that
    hold them are read.
    """
    spark = index.postings.sparkSession
    wanted = None
    for field, analyzer in index.fields.items():
        tokens = set(analyze_text(spark, query, analyzer))
        if tokens:
            test = (F.col("field") == field) & F.col("term").isin(*sorted(tokens))
            wanted = test if wanted is None else wanted | test
    wanted = F.lit(False) if wanted is None else wanted
    pruned = replace(
        index, postings=index.postings.where(wanted), term_stats=index.term_stats.where(wanted)
    )
    queries = spark.createDataFrame([("q", query)], "query_id string, query string")
    hits = search_many(pruned, queries, limit, boosts, documents, bounded=True)
    return hits.drop("query_id")
