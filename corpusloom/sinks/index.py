"""The stored search index: a base and the deltas of changed documents.

Every version folder holds ``postings`` and ``lengths``; a base also holds
``term_stats`` and the analyzers of its fields. ``lengths`` is written last and its
``_SUCCESS`` file marks the version as finished. ``lengths`` has the time of each
document, by which the newest version of an id wins, as in the document table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.analysis import (
    FIELD_ANALYZERS,
    CorpusIndex,
    analyze_documents,
    build_index,
    lengths_of,
    postings_of,
    stats_of_lengths,
    term_stats,
)
from ..plans import first_per_key
from ..schemas import DOCUMENT_SCHEMA
from .versions import hadoop_path, live_versions, next_version, versions

_FINISHED = "lengths/_SUCCESS"
_POSTINGS = ("field", "term", "id", "tf", "len")
_LENGTHS = ("field", "id", "len", "at")


def _write_postings(postings: DataFrame, path: str) -> None:
    """Postings by field, sorted by term, so that ``term IN (...)`` prunes files and
    row groups. The range includes the id and so cuts a very frequent term into
    several files."""
    (
        postings.repartitionByRange("field", "term", "id")
        .sortWithinPartitions("field", "term", "id")
        .write.partitionBy("field")
        .mode("overwrite")
        .parquet(f"{path}/postings")
    )


def _analyzed_once(
    analyzed: DataFrame, fields: dict[str, str], path: str
) -> tuple[DataFrame, DataFrame]:
    """Postings and lengths of documents that are analyzed in one pass.

    Sorting samples its input, and lengths are a second result: both read what the
    pass has written.
    """
    analyzed.write.mode("overwrite").parquet(f"{path}/analyzed")
    stored = analyzed.sparkSession.read.schema(analyzed.schema).parquet(f"{path}/analyzed")
    return postings_of(stored, fields), lengths_of(stored)


def _drop(spark: SparkSession, path: str) -> None:
    fs, jvm_path = hadoop_path(spark, path)
    fs.delete(jvm_path, True)


def write_index(index: CorpusIndex, root: str) -> None:
    """Write a new base; it replaces what was stored before once it is finished."""
    spark = index.postings.sparkSession
    path = next_version(spark, root, "base")
    postings, lengths = index.postings, index.lengths
    if index.analyzed is not None:
        postings, lengths = _analyzed_once(index.analyzed, index.fields, path)
    _write_postings(postings, path)
    stored = _read(spark, path, "postings", postings)
    (
        term_stats(stored)
        .repartitionByRange("field", "term")
        .sortWithinPartitions("field", "term")
        .write.partitionBy("field")
        .mode("overwrite")
        .parquet(f"{path}/term_stats")
    )
    spark.createDataFrame(list(index.fields.items()), "field string, analyzer string").coalesce(
        1
    ).write.mode("overwrite").parquet(f"{path}/analyzers")
    lengths.select(*_LENGTHS).write.mode("overwrite").parquet(f"{path}/lengths")
    _drop(spark, f"{path}/analyzed")


def create_index(
    spark: SparkSession, root: str, fields: dict[str, str] | None = None
) -> None:
    """Make an empty index of the document table's fields; an existing one stays."""
    if live_versions(spark, root, _FINISHED)[0] is None:
        empty = spark.createDataFrame([], DOCUMENT_SCHEMA)
        write_index(build_index(empty, fields or FIELD_ANALYZERS), root)


def update_index(
    spark: SparkSession,
    changed: DataFrame,
    root: str,
    id_col: str = "id",
    batch: str | None = None,
) -> None:
    """Index new or changed documents, one row per id; costs as much as they do.

    A delta with the key of a ``batch`` replaces the one that the same batch has written
    before, so that a replay changes nothing that is read. An older version of a
    document than the index holds, by ``scraped_at``, is not found.
    """
    base, _ = live_versions(spark, root, _FINISHED)
    if base is None:
        raise FileNotFoundError(f"no index at {root}")
    fields = _analyzers(spark, base.path)
    path = next_version(spark, root, "delta", batch)
    postings, lengths = _analyzed_once(analyze_documents(changed, fields, id_col), fields, path)
    _write_postings(postings, path)
    lengths.select(*_LENGTHS).write.mode("overwrite").parquet(f"{path}/lengths")
    _drop(spark, f"{path}/analyzed")
    live = {v.path for v in live_versions(spark, root, _FINISHED)[1]}
    own = [v for v in versions(spark, root) if v.batch is not None and path.endswith(f".{v.batch}")]
    for replaced in own:
        if replaced.path not in live:
            _drop(spark, replaced.path)


def compact_index(spark: SparkSession, root: str) -> None:
    """Fold the deltas into a new base."""
    if live_versions(spark, root, _FINISHED)[1]:
        write_index(open_index(spark, root), root)


def _read(spark: SparkSession, path: str, name: str, like: DataFrame) -> DataFrame:
    """A table partitioned by field; one without rows has no folder that names it."""
    return spark.read.schema(like.schema).parquet(f"{path}/{name}").select(*like.columns)


def open_index(spark: SparkSession, root: str) -> CorpusIndex:
    """The current index.

    The newest ``at`` of an id wins, then the last written. Base postings of changed
    documents are dropped by an anti join on their ids. Document frequencies are stored
    for a base alone; with deltas they are counted from the postings, where the terms of
    a query prune first.
    """
    base, deltas = live_versions(spark, root, _FINISHED)
    if base is None:
        raise FileNotFoundError(f"no index at {root}")
    fields = _analyzers(spark, base.path)
    lengths = spark.read.parquet(f"{base.path}/lengths").select(*_LENGTHS)
    id_type = lengths.schema["id"].dataType.simpleString()
    shape = spark.createDataFrame(
        [], f"field string, term string, id {id_type}, tf bigint, len bigint"
    )
    postings = _read(spark, base.path, "postings", shape)
    if not deltas:
        counts = spark.createDataFrame([], "field string, term string, df bigint")
        stats = _read(spark, base.path, "term_stats", counts)
        return CorpusIndex(postings, lengths, stats, stats_of_lengths(lengths), fields)

    def versioned(frames: list[DataFrame]) -> DataFrame:
        out = None
        for v, frame in zip(deltas, frames):
            frame = frame.withColumn("_v", F.lit(v.number))
            out = frame if out is None else out.unionByName(frame)
        return out

    delta_lengths = versioned(
        [spark.read.parquet(f"{v.path}/lengths").select(*_LENGTHS) for v in deltas]
    )
    delta_postings = versioned([_read(spark, v.path, "postings", shape) for v in deltas])
    order = [F.desc_nulls_last("at"), F.desc("_v")]
    newest = first_per_key(delta_lengths.select("id", "at", "_v"), ["id"], order)
    # Every document has a row for each field: one names it.
    held = lengths.where(F.col("field") == next(iter(fields)))
    held = held.select("id", F.col("at").alias("_held"))
    older = F.col("_held").isNotNull() & (F.col("at").isNull() | (F.col("at") < F.col("_held")))
    won = newest.join(held, "id", "left").where(~older).select("id", "_v")

    def merged(stored: DataFrame, fresh: DataFrame, columns: tuple) -> DataFrame:
        kept = stored.join(won.select("id"), "id", "left_anti")
        fresh = fresh.join(won, ["id", "_v"], "left_semi")
        return kept.select(*columns).unionByName(fresh.select(*columns))

    postings = merged(postings, delta_postings, _POSTINGS)
    lengths = merged(lengths, delta_lengths, _LENGTHS)
    return CorpusIndex(postings, lengths, term_stats(postings), stats_of_lengths(lengths), fields)


def _analyzers(spark: SparkSession, path: str) -> dict[str, str]:
    rows = spark.read.parquet(f"{path}/analyzers").collect()
    return {row["field"]: row["analyzer"] for row in rows}
