"""The document table: keyed upserts on plain Parquet folders.

A table is a folder of numbered versions. ``base-N`` holds every document up to
version N, ``delta-N`` the documents changed by version N. Spark's ``_SUCCESS``
file marks a finished version, so an unfinished write is never read and no file
that a reader may hold is changed in place. An upsert writes its batch and reads
nothing; readers keep the newest ``scraped_at`` per id. ``compact_documents``, which
only a caller starts, folds the deltas into a new base.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import broadcast_if_bounded, cut_lineage, first_per_key
from ..schemas import DOCUMENT_SCHEMA
from ..sources.pages import scan_documents
from .versions import hadoop_path, live_versions, next_version, versions


def latest_by_id(df: DataFrame, *newest_first: Column) -> DataFrame:
    return first_per_key(df, ["id"], list(newest_first))


def _write(df: DataFrame, path: str, finished: bool = True) -> None:
    """A version with a bloom filter on the id, for lookups and later upserts."""
    (
        df.write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#id", "true")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(finished).lower())
        .parquet(path)
    )


def create_document_table(spark: SparkSession, root: str) -> None:
    """Make an empty table; an existing one is left as it is."""
    if live_versions(spark, root) == (None, []):
        empty = spark.createDataFrame([], DOCUMENT_SCHEMA)
        _write(empty, next_version(spark, root, "base"))


def drop_document_table(spark: SparkSession, root: str) -> None:
    """Remove the table; a missing one is not an error."""
    fs, jvm_path = hadoop_path(spark, root)
    fs.delete(jvm_path, True)
    spark.catalog.refreshByPath(root)


def read_document_table(spark: SparkSession, root: str) -> DataFrame:
    """The current documents: the newest ``scraped_at`` per id, then the last written.

    Base rows for which a delta holds something as new are removed by an anti join,
    and so are delta rows older than what the base holds. The base is not regrouped,
    and only its ids and times are read for the second join.
    """
    base, deltas = live_versions(spark, root)
    if base is None and not deltas:
        raise FileNotFoundError(f"no document table at {root}")
    if not deltas:
        return scan_documents(spark, base.path)
    frames = [
        scan_documents(spark, v.path).withColumn("_version", F.lit(v.number)) for v in deltas
    ]
    changed = frames[0]
    for frame in frames[1:]:
        changed = changed.unionByName(frame)
    order = (F.desc_nulls_last("scraped_at"), F.desc("_version"))
    if len(deltas) > 1:
        changed = latest_by_id(changed, *order)
    changed = changed.drop("_version")
    if base is None:
        return changed
    held = scan_documents(spark, base.path)
    # Times of the deltas alone: their narrow columns are ranked, not the contents.
    times = frames[0].select("id", "scraped_at", "_version")
    for frame in frames[1:]:
        times = times.unionByName(frame.select("id", "scraped_at", "_version"))
    new = latest_by_id(times, *order).select("id", F.col("scraped_at").alias("_new"))
    old = held.select("id", F.col("scraped_at").alias("_old"))
    replaced = F.col("scraped_at").isNull() | (F.col("_new") >= F.col("scraped_at"))
    outdated = F.col("_old").isNotNull() & (
        F.col("scraped_at").isNull() | (F.col("scraped_at") < F.col("_old"))
    )
    kept = held.join(new, (held["id"] == new["id"]) & replaced, "left_anti")
    fresh = changed.join(old, (changed["id"] == old["id"]) & outdated, "left_anti")
    return kept.unionByName(fresh)


def upsert_documents(spark: SparkSession, documents: DataFrame, root: str) -> None:
    """Replace documents by id, the newest ``scraped_at`` winning.

    Costs as much as the batch. Replaying a batch, or an older one, changes nothing
    that is read. One writer at a time.
    """
    create_document_table(spark, root)
    path = next_version(spark, root, "delta")
    # Written as it comes: only if ids repeat, their rows are regrouped.
    _write(documents.select(*DOCUMENT_SCHEMA.names), path, finished=False)
    batch = scan_documents(spark, path)
    ids = batch.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    repeated = cut_lineage(ids.where("_n > 1").select(F.col("id").alias("_id")))
    if repeated.isEmpty():
        fs, marker = hadoop_path(spark, f"{path}/_SUCCESS")
        fs.create(marker).close()
    else:
        several, _ = broadcast_if_bounded(repeated)
        same = F.col("id").eqNullSafe(F.col("_id"))
        again = latest_by_id(
            batch.join(several, same, "left_semi"), F.desc_nulls_last("scraped_at"), F.desc("content")
        )
        once = batch.join(several, same, "left_anti").unionByName(again)
        _write(once, next_version(spark, root, "delta"))
        fs, unfinished = hadoop_path(spark, path)
        fs.delete(unfinished, True)
    spark.catalog.refreshByPath(root)


def compact_documents(spark: SparkSession, root: str) -> None:
    """Fold the deltas into a new base; the previous generation stays readable."""
    base, deltas = live_versions(spark, root)
    if not deltas:
        return
    old = [v for v in versions(spark, root) if base is not None and v.number < base.number]
    # Sorted ids let a lookup skip almost every file and row group of the base.
    folded = read_document_table(spark, root).repartitionByRange("id").sortWithinPartitions("id")
    _write(folded, f"{root}/base-{deltas[-1].number:010d}")
    for version in old:
        fs, jvm_path = hadoop_path(spark, version.path)
        fs.delete(jvm_path, True)
    spark.catalog.refreshByPath(root)
