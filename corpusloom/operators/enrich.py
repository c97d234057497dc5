"""Tags, summaries and embeddings."""

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse_tags, trim_ws
from ..functions.models import DEFAULT_DIMS, model_input
from ..plans import broadcast_if_bounded, cut_lineage, hot_keys, salted_join
from .analysis import STANDARD, analyze, build_postings

TAGS_PER_DOCUMENT = 15

# A text model: (titles, contents) -> one (comma list of tags, summary) per document.
TextModel = Callable[[Sequence[str], Sequence[str]], Sequence[tuple[str, str]]]
# An embedding model: texts -> one vector per text.
EmbeddingModel = Callable[[Sequence[str]], Sequence[Sequence[float]]]

_ANSWER = T.StructType(
    [
        T.StructField("tags", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
_VECTOR = T.StructType(
    [T.StructField("vector", T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())]
)


def _answers(model, rows: list[tuple]) -> list[tuple]:
    """(answer, error) per row. A whole batch is asked for at once; if that fails, row
    by row, so that one bad document costs only its own answer."""
    if not rows:
        return []
    try:
        answers = list(model(*map(list, zip(*rows))))
        if len(answers) == len(rows):
            return [(answer, None) for answer in answers]
    except Exception:
        pass  # each row is asked for by itself below, and keeps its own reason
    out = []
    for row in rows:
        try:
            out.append((list(model(*[[value] for value in row]))[0], None))
        except Exception as error:
            out.append((None, f"{type(error).__name__}: {error}"))
    return out


def enrich(
    documents: DataFrame,
    make_model: Callable[[], TextModel],
    title_col: str = "title",
    content_col: str = "content",
    max_bytes: int | None = None,
) -> DataFrame:
    """Set ``tags`` and ``summary`` from a model made once per partition.

    The model sees the title and the content, cut to ``max_bytes`` bytes if given.
    A document whose call fails keeps both empty and has the reason in
    ``enrich_error``. Only the two texts cross to Python; all other columns stay in
    the JVM.
    """

    @F.pandas_udf(_ANSWER)
    def ask(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for titles, contents in batches:
            answers = _answers(model, list(zip(titles, contents)))
            rows = [(*(found or (None, None)), error) for found, error in answers]
            yield pd.DataFrame(rows, columns=_ANSWER.names, index=titles.index)

    answered = documents.withColumn(
        "_answer", ask(F.col(title_col), model_input(content_col, max_bytes))
    )
    complete = F.col("_answer.tags").isNotNull() & F.col("_answer.summary").isNotNull()
    tags = parse_tags("_answer.tags")
    return answered.withColumns(
        {
            "tags": F.when(complete & (F.size(tags) > 0), tags),
            "summary": F.when(complete, F.nullif(trim_ws("_answer.summary"), F.lit(""))),
            "enrich_error": F.col("_answer.error"),
        }
    ).drop("_answer")


def tfidf_tags(
    documents: DataFrame,
    n_tags: int = TAGS_PER_DOCUMENT,
    id_col: str = "id",
    content_col: str = "content",
) -> DataFrame:
    """``id, tags``: the best terms of each document by ``tf * ln(N / df)``.

    The model-free tagger. Term frequencies are formed inside the row, document
    frequencies with partial aggregation; the join of both salts the terms that
    occur in very many documents.
    """
    # The text is tokenized once: frequencies and weights read the written postings.
    postings = cut_lineage(
        build_postings(documents, {content_col: STANDARD}, id_col).select("id", "term", "tf")
    )
    counts = cut_lineage(postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    small, bounded = broadcast_if_bounded(counts)
    if bounded:
        weighted = postings.join(small, "term")
    else:
        hot = hot_keys(counts, ["term"], "df")
        weighted = salted_join(postings, counts.hint("shuffle_hash"), ["term"], ["id"], hot)
    total = documents.count()
    weight = F.round(F.col("tf") * F.ln(F.lit(float(total)) / F.col("df")), 9)
    window = Window.partitionBy("id").orderBy(F.desc("weight"), "term")
    ranked = (
        weighted.select("id", "term", weight.alias("weight"))
        .withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= n_tags)
    )
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return ranked.groupBy("id").agg(F.transform(ordered, lambda t: t["term"]).alias("tags"))


def lead_summary(content: Column | str) -> Column:
    """First paragraph that is not a heading; the model-free summary."""
    text = F.col(content) if isinstance(content, str) else content
    paragraphs = F.transform(F.split(text, r"\n[\t\r ]*\n"), trim_ws)
    prose = F.filter(paragraphs, lambda p: (p != "") & ~p.startswith("#"))
    return F.get(prose, F.lit(0))


def enrich_default(documents: DataFrame) -> DataFrame:
    """Tags and summary without a model."""
    tags = tfidf_tags(documents)
    return (
        documents.drop("tags", "summary")
        .join(tags, "id", "left")
        .withColumn("summary", lead_summary("content"))
    )


def embed(
    documents: DataFrame,
    make_model: Callable[[], EmbeddingModel],
    dims: int | None = None,
    content_col: str = "content",
    max_bytes: int | None = None,
) -> DataFrame:
    """Set ``embedding`` from a model made once per partition.

    The model sees the content, cut to ``max_bytes`` bytes if given. A failed call
    leaves null and its reason in ``embedding_error``. With ``dims`` a vector of another size is set to
    null too and ``embedding_error`` says so.
    """

    @F.pandas_udf(_VECTOR)
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for texts in batches:
            answers = _answers(model, [(t,) for t in texts])
            yield pd.DataFrame(answers, columns=_VECTOR.names, index=texts.index)

    answered = documents.withColumn("_answer", ask(model_input(content_col, max_bytes)))
    embedded = answered.withColumns(
        {"embedding": F.col("_answer.vector"), "embedding_error": F.col("_answer.error")}
    ).drop("_answer")
    return check_dims(embedded, dims)


def check_dims(documents: DataFrame, dims: int | None) -> DataFrame:
    """Null out vectors of a wrong size and record them in ``embedding_error``."""
    if dims is None:
        return documents
    wrong = F.col("embedding").isNotNull() & (F.size("embedding") != dims)
    message = F.concat(F.lit(f"embedding: expected {dims} values, got "), F.size("embedding"))
    known = F.col("embedding_error") if "embedding_error" in documents.columns else F.lit(None)
    return documents.withColumn(
        "embedding_error", F.when(wrong, message).otherwise(known.cast("string"))
    ).withColumn("embedding", F.when(~wrong, F.col("embedding")))


def embed_default(
    documents: DataFrame,
    dims: int = DEFAULT_DIMS,
    content_col: str = "content",
    max_bytes: int | None = None,
) -> DataFrame:
    """Hashed tf-idf vectors of unit length, all in the JVM.

    A token falls into the bucket of its MD5 digest's first eight hex digits.
    """
    words = analyze(model_input(content_col, max_bytes), STANDARD)
    bucket = lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % dims
    tokens = documents.withColumn(
        "_tokens", F.transform(words, lambda w: bucket(w).cast("string"))
    )
    buckets = CountVectorizerModel.from_vocabulary(
        [str(n) for n in range(dims)], inputCol="_tokens", outputCol="_tf"
    )
    stages = Pipeline(
        stages=[
            buckets,
            IDF(inputCol="_tf", outputCol="_idf"),
            Normalizer(inputCol="_idf", outputCol="_unit"),
        ]
    )
    fitted = stages.fit(tokens.select("_tokens"))
    vector = vector_to_array("_unit", "float32")
    # A text without tokens has no direction and so no vector.
    vector = F.when(F.size("_tokens") > 0, vector)
    return (
        fitted.transform(tokens)
        .withColumn("embedding", vector)
        .drop("_tokens", "_tf", "_idf", "_unit")
    )
