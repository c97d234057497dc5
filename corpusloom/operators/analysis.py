"""Analyzers, postings and corpus statistics."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stemming import STOP_WORDS, porter_stem, stem_tokens, stem_words
from ..functions.text import as_column
from ..plans import broadcast_if_bounded, cut_lineage, hot_keys, salted_join

STANDARD = "standard"
ENGLISH = "english"

# Field -> analyzer of the document table.
FIELD_ANALYZERS = {
    "content": ENGLISH,
    "title": STANDARD,
    "tags": ENGLISH,
    "summary": ENGLISH,
}

_WORD = r"[\p{L}\p{N}_]+"
_WORD_OR_POSSESSIVE = r"[\p{L}\p{N}_]+(?:['’]s\b)?"


def analyze(text: Column | str, analyzer: str = STANDARD) -> Column:
    """Token array of a text column; null text has no tokens.

    ``standard``: runs of letters, digits and underscores, lower-cased.
    ``english``: also drops a possessive 's and stop words, then stems. Every token is
    stemmed by itself: this is for short texts such as queries; documents go through
    :func:`build_postings`, which stems their distinct words.
    """
    words = analyze_words(text, analyzer)
    return stem_tokens(words) if analyzer == ENGLISH else words


def analyze_words(text: Column | str, analyzer: str = STANDARD) -> Column:
    """The words of a text before any stemming, in the JVM."""
    text = F.lower(F.coalesce(as_column(text), F.lit("")))
    if analyzer == STANDARD:
        return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    if analyzer != ENGLISH:
        raise ValueError(f"unknown analyzer {analyzer!r}")
    words = F.regexp_extract_all(text, F.lit(_WORD_OR_POSSESSIVE), F.lit(0))
    words = F.transform(words, lambda w: F.regexp_replace(w, r"['’]s$", ""))
    return F.filter(words, lambda w: ~w.isin(*STOP_WORDS))


def field_text(df: DataFrame, field: str) -> Column:
    """A field as one text; the values of an array field are kept on own lines,
    which analyzes them one by one because no token spans a line end."""
    if df.schema[field].dataType.typeName() == "array":
        return F.array_join(F.col(field), "\n")
    return F.col(field)


def analyze_text(spark: SparkSession, text: str, analyzer: str) -> list[str]:
    """Tokens of one query string held by the driver."""
    rows = spark.sql("SELECT * FROM VALUES (:text) AS q(text)", args={"text": text})
    if analyzer == STANDARD:
        return rows.select(analyze("text")).first()[0]
    words = F.regexp_extract_all(F.lower("text"), F.lit(_WORD_OR_POSSESSIVE), F.lit(0))
    tokens = [w[:-2] if w.endswith(("'s", "’s")) else w for w in rows.select(words).first()[0]]
    return [porter_stem(w) for w in tokens if w not in STOP_WORDS]


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of a token array, worked out inside the row.

    The tokens are sorted and each run of equal tokens becomes one entry, so a
    document's term frequencies need neither a shuffle nor a hash table.
    """

    def runs(words: Column) -> Column:
        first = F.filter(
            F.sequence(F.lit(1), F.size(words)),
            lambda i: F.get(words, i - 2).isNull() | (F.get(words, i - 1) != F.get(words, i - 2)),
        )
        return _let(
            first,
            lambda at: F.transform(
                at,
                lambda start, n: F.struct(
                    F.get(words, start - 1).alias("term"),
                    (F.coalesce(F.get(at, n + 1), F.size(words) + 1) - start)
                    .cast("bigint")
                    .alias("tf"),
                ),
            ),
        )

    nothing = F.array().cast("array<struct<term:string,tf:bigint>>")
    return F.when(F.size(tokens) > 0, _let(F.sort_array(tokens), runs)).otherwise(nothing)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokenize(
    documents: DataFrame,
    fields: dict[str, str],
    id_col: str = "id",
) -> DataFrame:
    """``id`` and one array per field: its words, those of English fields not stemmed."""
    return documents.select(
        F.col(id_col).alias("id"),
        *[analyze_words(field_text(documents, f), a).alias(f) for f, a in fields.items()],
    )


def analyze_documents(
    documents: DataFrame,
    fields: dict[str, str] | None = None,
    id_col: str = "id",
) -> DataFrame:
    """``id, at, entries, lens``: each document's words per field; a narrow operation.

    ``entries`` are ``field, term, tf, len``, of words that are not stemmed yet; ``lens`` are
    ``field, len``; ``at`` is the document's ``scraped_at``, if it has one.
    """
    fields = fields or present_fields(documents)
    at = F.col("scraped_at") if "scraped_at" in documents.columns else F.lit(None)
    tokens = documents.select(
        F.col(id_col).alias("id"),
        at.cast("timestamp").alias("at"),
        *[analyze_words(field_text(documents, f), a).alias(f) for f, a in fields.items()],
    )

    def entries_of(field: str) -> Column:
        length = F.size(field).cast("bigint")
        return F.transform(
            term_counts(F.col(field)),
            lambda e: F.struct(
                F.lit(field).alias("field"),
                e["term"].alias("term"),
                e["tf"].alias("tf"),
                length.alias("len"),
            ),
        )

    lens = [
        F.struct(F.lit(f).alias("field"), F.size(f).cast("bigint").alias("len")) for f in fields
    ]
    entries = F.flatten(F.array(*[entries_of(f) for f in fields]))
    return tokens.select("id", "at", entries.alias("entries"), F.array(*lens).alias("lens"))


def postings_of(analyzed: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Postings ``field, term, id, tf, len`` of :func:`analyze_documents`.

    Those of English fields are stemmed, for which the documents are read twice more.
    """
    # Outer: an inner one is filtered first, which would make the entries twice.
    rows = (
        analyzed.select("id", F.inline_outer("entries"))
        .where(F.col("term").isNotNull())
        .select("field", "term", "id", "tf", "len")
    )
    english = [f for f, a in fields.items() if a == ENGLISH]
    if not english:
        return rows
    stemmed = stem_postings(rows.where(F.col("field").isin(english)))
    if len(english) == len(fields):
        return stemmed
    return rows.where(~F.col("field").isin(english)).unionByName(stemmed)


def stem_postings(postings: DataFrame) -> DataFrame:
    """Postings of words as postings of stems.

    Only distinct words are stemmed. The vocabulary is broadcast if its measured size
    allows; else words of very many documents are salted by document. Words of one
    stem in a document become one posting.
    """
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = cut_lineage(counts.withColumn("stem", stem_words("term")))
    small, fits = broadcast_if_bounded(vocabulary.drop("n"))
    if fits:
        stemmed = postings.join(small, "term")
    else:
        hot = hot_keys(vocabulary, ["term"], "n")
        stemmed = salted_join(postings, vocabulary.drop("n"), ["term"], ["id"], hot)
    return (
        stemmed.groupBy("field", "stem", "id")
        .agg(F.sum("tf").alias("tf"), F.max("len").alias("len"))
        .select("field", F.col("stem").alias("term"), "id", "tf", "len")
    )


def lengths_of(analyzed: DataFrame) -> DataFrame:
    """``field, id, len, at`` of every document and field."""
    return analyzed.select("id", "at", F.inline_outer("lens")).select("field", "id", "len", "at")


def build_postings(
    documents: DataFrame,
    fields: dict[str, str] | None = None,
    id_col: str = "id",
) -> DataFrame:
    """Postings ``field, term, id, tf, len``.

    ``len`` is the token count of the field in the document. Carrying it with
    every posting spares scoring a join on document lengths. A narrow operation for
    standard fields; with English ones the words of the documents are written to the
    checkpoint folder first, so that texts are read once.
    """
    fields = fields or present_fields(documents)
    analyzed = analyze_documents(documents, fields, id_col)
    return postings_of(cut_lineage(analyzed) if ENGLISH in fields.values() else analyzed, fields)


def present_fields(documents: DataFrame) -> dict[str, str]:
    return {f: a for f, a in FIELD_ANALYZERS.items() if f in documents.columns}


def term_stats(postings: DataFrame) -> DataFrame:
    """Document frequency ``df`` per field and term."""
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def field_stats(
    documents: DataFrame,
    fields: dict[str, str] | None = None,
    id_col: str = "id",
) -> DataFrame:
    """``doc_count`` and ``avg_len`` per field over documents with terms in it.

    One row per field, from one partially aggregated pass.
    """
    fields = fields or present_fields(documents)
    tokens = tokenize(documents, fields, id_col)
    sizes = tokens.select(*[F.size(f).alias(f) for f in fields])
    totals = sizes.agg(*_length_totals(fields, lambda f: F.col(f)))
    rows = [
        F.struct(
            F.lit(f).alias("field"),
            F.col(f"{f}_docs").alias("doc_count"),
            F.try_divide(F.col(f"{f}_len").cast("double"), F.col(f"{f}_docs")).alias("avg_len"),
        )
        for f in fields
    ]
    return totals.select(F.inline(F.array(*rows))).where(F.col("doc_count") > 0)


def _length_totals(fields, size) -> list[Column]:
    return [
        total
        for f in fields
        for total in (
            F.count_if(size(f) > 0).alias(f"{f}_docs"),
            F.sum(size(f).cast("bigint")).alias(f"{f}_len"),
        )
    ]


@dataclass(frozen=True)
class CorpusIndex:
    """Derived tables of a corpus; lazy until written (see ``sinks.index``).

    ``lengths`` has ``field, id, len, at`` for every document and field, also where
    ``len`` is 0, and so lists the documents the index covers. ``analyzed``, if there,
    gives both in one pass (see :func:`analyze_documents`).
    """

    postings: DataFrame
    lengths: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    fields: dict[str, str]
    analyzed: DataFrame | None = None


def stats_of_lengths(lengths: DataFrame) -> DataFrame:
    """``field_stats`` from stored lengths."""
    return (
        lengths.where(F.col("len") > 0)
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("doc_count"), F.avg("len").alias("avg_len"))
    )


def build_corpus_stats(
    documents: DataFrame, fields: dict[str, str] | None = None, id_col: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """``(term_stats, field_stats)`` of a corpus."""
    return (
        term_stats(build_postings(documents, fields, id_col)),
        field_stats(documents, fields, id_col),
    )


def build_index(
    documents: DataFrame, fields: dict[str, str] | None = None, id_col: str = "id"
) -> CorpusIndex:
    fields = fields or present_fields(documents)
    analyzed = analyze_documents(documents, fields, id_col)
    if ENGLISH in fields.values():
        analyzed = cut_lineage(analyzed)
    postings, lengths = postings_of(analyzed, fields), lengths_of(analyzed)
    return CorpusIndex(
        postings, lengths, term_stats(postings), stats_of_lengths(lengths), fields, analyzed
    )
