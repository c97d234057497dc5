"""Ingestion of finished scrapes into the document table."""

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.documents import build_documents
from ..operators.enrich import EmbeddingModel, TextModel
from ..operators.manifests import attach_urls
from ..operators.metrics import split_errors
from ..plans import cut_lineage
from ..sinks.index import create_index, update_index
from ..sinks.table import create_document_table, latest_by_id, upsert_documents
from ..sinks.versions import path_exists
from ..sources.staged import (
    read_manifests,
    scan_manifests,
    scan_staged_pages,
    scan_staged_table,
)

MANIFESTS_PER_BATCH = 1000


@dataclass(frozen=True)
class IngestOptions:
    """Stages and layout of an ingestion; a missing model leaves its stage out.

    ``index`` is where the search index of the table is kept current; it is made if
    it is missing.
    """

    layout: str = "tree"
    recursive: bool = False
    make_text_model: Callable[[], TextModel] | None = None
    make_embedding_model: Callable[[], EmbeddingModel] | None = None
    dims: int | None = None
    max_bytes: int | None = None
    index: str | None = None


@dataclass(frozen=True)
class IngestResult:
    scrapes: int
    pages: int
    docs_indexed: int
    errors: int
    duration_ms: int
    failed: list[tuple[str, str]] = field(default_factory=list)


def _staged_pages(
    spark: SparkSession, root: str, manifests: DataFrame, prefixes: list[str], layout: str
) -> DataFrame:
    """Page rows of the given scrapes, with URL and the manifest's time."""
    if layout == "table":
        pages = scan_staged_table(spark, root, manifests)
    else:
        pages = attach_urls(scan_staged_pages(spark, root, prefixes), manifests).withColumn(
            "content_type", F.lit("")
        )
    return pages.select(
        "url", "content_type", F.col("content").alias("body"), "scraped_at", "scrape_prefix"
    )


def ingest_scrapes(
    spark: SparkSession,
    root: str,
    table: str,
    manifests: DataFrame,
    prefixes: list[str],
    options: IngestOptions = IngestOptions(),
    batch: str = "manual",
) -> IngestResult:
    """Build and upsert the documents of finished scrapes in one job.

    The table layout takes its scrapes from ``manifests``, the tree layout its
    folders from ``prefixes`` (one manifest file each, so bounded per batch).

    ``scraped_at`` comes from the scrape, not the clock, so that a replay writes
    the same documents. With ``options.index`` the batch's postings are a delta of the
    index, which a replay of the batch replaces. Rows that fail go to ``{table}/quarantine/batch={batch}``,
    which a replay of the batch replaces.
    """
    started = time.monotonic()
    create_document_table(spark, table)
    pages = _staged_pages(spark, root, manifests, prefixes, options.layout)
    # Conversion and models run once: the counts, the upsert and the quarantine
    # all read the checkpointed rows.
    built = cut_lineage(
        build_documents(
            pages,
            options.make_text_model,
            options.make_embedding_model,
            options.dims,
            options.max_bytes,
        )
    )
    good, bad = split_errors(built)
    n_pages, n_good = built.agg(
        F.count(F.lit(1)), F.count_if(F.col("error").isNull())
    ).first()
    if n_good:
        upsert_documents(spark, good, table)
        if options.index is not None:
            create_index(spark, options.index)
            order = (F.desc_nulls_last("scraped_at"), F.desc("content"))
            update_index(spark, latest_by_id(good, *order), options.index, batch=batch)
    if n_pages > n_good:
        bad.select("id", "url", "scraped_at", "error").write.mode("overwrite").parquet(
            f"{table}/quarantine/batch={batch}"
        )
    scrapes = manifests.select("scrape_prefix").distinct().count()
    elapsed = int((time.monotonic() - started) * 1000)
    return IngestResult(scrapes, n_pages, n_good, n_pages - n_good, elapsed)


def _without_pages(
    spark: SparkSession, root: str, manifests: DataFrame, layout: str
) -> list[str]:
    """Scrapes of a batch that have a manifest and no staged pages."""
    wanted = manifests.select("scrape_prefix").distinct()
    if layout == "table":
        if not path_exists(spark, f"{root}/staged"):
            return sorted(row[0] for row in wanted.collect())
        there = scan_staged_table(spark, root, manifests).select("scrape_prefix").distinct()
        return sorted(row[0] for row in wanted.join(there, "scrape_prefix", "left_anti").collect())
    prefixes = sorted(row[0] for row in wanted.collect())
    return [p for p in prefixes if not path_exists(spark, f"{root}/{p}/pages")]


def ingest_manifests(
    spark: SparkSession,
    root: str,
    table: str,
    manifests: DataFrame,
    options: IngestOptions = IngestOptions(),
    batch: str = "manual",
) -> IngestResult:
    """Ingest a batch of finished scrapes; one that fails costs only itself.

    All scrapes are ingested in one job. If that fails, each is tried by itself.
    Scrapes without pages and those that fail are in ``failed`` with the reason, and
    in ``{table}/failed_scrapes/batch={batch}``, which a replay replaces.
    """
    manifests = cut_lineage(manifests)
    failed = [(p, "no staged pages") for p in _without_pages(spark, root, manifests, options.layout)]
    ready = manifests.where(~F.col("scrape_prefix").isin([p for p, _ in failed]))
    prefixes = sorted(row[0] for row in ready.select("scrape_prefix").distinct().collect())
    result = IngestResult(0, 0, 0, 0, 0)
    if prefixes:
        try:
            result = ingest_scrapes(spark, root, table, ready, prefixes, options, batch)
        except Exception:  # found out below, scrape by scrape
            for number, prefix in enumerate(prefixes):
                own = ready.where(F.col("scrape_prefix") == prefix)
                name = f"{batch}-{number}"
                try:
                    one = ingest_scrapes(spark, root, table, own, [prefix], options, name)
                except Exception as error:
                    failed.append((prefix, f"{type(error).__name__}: {error}"[:1000]))
                else:
                    result = _sum(result, one)
    if failed:
        spark.createDataFrame(failed, "scrape_prefix string, error string").write.mode(
            "overwrite"
        ).parquet(f"{table}/failed_scrapes/batch={batch}")
    return replace(result, failed=failed)


def _sum(a: IngestResult, b: IngestResult) -> IngestResult:
    return IngestResult(
        a.scrapes + b.scrapes,
        a.pages + b.pages,
        a.docs_indexed + b.docs_indexed,
        a.errors + b.errors,
        a.duration_ms + b.duration_ms,
    )


def ingest_prefix(
    spark: SparkSession,
    root: str,
    table: str,
    prefix: str,
    options: IngestOptions = IngestOptions(),
) -> IngestResult:
    """Ingest one scrape again from storage; a missing manifest is an error."""
    manifests = scan_manifests(spark, root, prefix, options.layout)
    if manifests.isEmpty():
        raise FileNotFoundError(f"no manifest for {prefix}")
    batch = f"scrape-{hashlib.sha256(prefix.encode()).hexdigest()[:16]}"
    return ingest_scrapes(spark, root, table, manifests, [prefix], options, batch)


def stream_manifests(
    spark: SparkSession,
    root: str,
    layout: str = "tree",
    max_files: int = MANIFESTS_PER_BATCH,
    recursive: bool = False,
) -> DataFrame:
    """Streaming rows of newly written manifests, one event per finished scrape."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    return read_manifests(reader, root, layout, recursive=recursive)


def stream_ingest(
    spark: SparkSession,
    root: str,
    table: str,
    checkpoint: str,
    options: IngestOptions = IngestOptions(),
    max_files: int = MANIFESTS_PER_BATCH,
    on_result: Callable[[IngestResult], None] | None = None,
    trigger: dict | None = None,
    index: str | None = None,
) -> StreamingQuery:
    """Ingest every finished scrape as its manifest appears.

    A batch holds at most ``max_files`` manifest files. Scrapes that fail or whose
    pages are missing are reported and the stream goes on. A replayed batch writes
    the same documents, quarantine and failures again. With ``index``, a batch is in the search
    index stored there as soon as it is ingested.
    """
    if index is not None:
        options = replace(options, index=index)

    def ingest_batch(batch: DataFrame, batch_id: int) -> None:
        result = ingest_manifests(
            batch.sparkSession, root, table, batch, options, f"{batch_id}"
        )
        if on_result is not None:
            on_result(result)

    return (
        stream_manifests(spark, root, options.layout, max_files, options.recursive)
        .writeStream.foreachBatch(ingest_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
