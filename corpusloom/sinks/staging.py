"""Staged pages and their manifests."""

from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions import document_id
from ..plans import hot_keys
from ..schemas import MANIFEST_SCHEMA
from ..sources.staged import STAGED_SCHEMA

PAGES_PER_MANIFEST_ROW = 100_000


def stage_pages(pages: DataFrame, root: str) -> None:
    """Write pages (page schema plus ``scrape_prefix``) partitioned by host and run.

    The rebalance hint groups the rows of a run into few files and lets AQE split
    a run that is far larger than the others. Writing a run again replaces it.
    """
    parts = F.split("scrape_prefix", "/")
    staged = pages.select(
        "url",
        "content_type",
        F.col("body").alias("content"),
        "scraped_at",
        "scrape_prefix",
        F.concat(document_id("url"), F.lit(".md")).alias("file_name"),
        F.get(parts, F.lit(1)).alias("host"),
        F.get(parts, F.lit(2)).alias("run"),
    ).select(*STAGED_SCHEMA.names)
    (
        staged.hint("rebalance", "host", "run")
        .write.partitionBy("host", "run")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(f"{root}/staged")
    )


def write_objects(objects: DataFrame) -> None:
    """Write rows of (URI, text) as one object each; tasks write what they hold.

    A repeated attempt of a task writes the same objects again.
    """

    def write(rows: Iterator[Row]) -> None:
        made = set()
        for uri, text in rows:
            system, path = fs.FileSystem.from_uri(uri)
            folder = path.rsplit("/", 1)[0]
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            with system.open_output_stream(path, compression=None) as stream:
                stream.write((text or "").encode())

    objects.foreachPartition(write)


def manifest_rows(pages: DataFrame, max_pages: int = PAGES_PER_MANIFEST_ROW) -> DataFrame:
    """Manifest rows of scraped pages (``scrape_prefix, source_url, url, scraped_at``).

    The counts come from a partially aggregated group-by. Only scrapes larger than
    ``max_pages`` are split further, by URL hash, so that no list grows past it.
    """
    scrapes = pages.groupBy("scrape_prefix").agg(
        F.min("source_url").alias("source_url"),
        F.max("scraped_at").alias("timestamp"),
        F.count(F.lit(1)).alias("page_count"),
    )
    hot = hot_keys(scrapes, ["scrape_prefix"], "page_count", max_pages, max_splits=2**31 - 1)
    url_hash = F.conv(F.substring(document_id("url"), 1, 8), 16, 10).cast("bigint")
    lists = (
        pages.select("scrape_prefix", "url")
        .join(F.broadcast(hot), "scrape_prefix", "left")
        .withColumn("parts", F.coalesce("_splits", F.lit(1)))
        .withColumn("part", F.pmod(url_hash, F.col("parts").cast("bigint")).cast("int"))
        .groupBy("scrape_prefix", "part", "parts")
        .agg(F.sort_array(F.collect_list("url")).alias("pages"))
    )
    return lists.join(scrapes, "scrape_prefix").select(*MANIFEST_SCHEMA.names)


def write_manifests(pages: DataFrame, root: str, max_pages: int = PAGES_PER_MANIFEST_ROW) -> None:
    """Write the manifests; call it after ``stage_pages``, as the commit mark.

    All rows of a scrape stand in one file, so that a stream gets them in one batch.
    """
    (
        manifest_rows(pages, max_pages)
        .repartition("scrape_prefix")
        .write.mode("append")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .json(f"{root}/manifests")
    )
