"""URLs of staged files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import document_id
from ..plans import salted_join


def attach_urls(staged: DataFrame, manifests: DataFrame) -> DataFrame:
    """Add ``url`` and ``scraped_at`` to staged files from their manifests.

    A file is named after the id of its URL. A file the manifest does not list
    keeps its name as URL.
    """
    listed = (
        manifests.select("scrape_prefix", F.explode("pages").alias("_url"))
        .withColumn("file_name", F.concat(document_id("_url"), F.lit(".md")))
        .groupBy("scrape_prefix", "file_name")
        .agg(F.min("_url").alias("_url"))
    )
    times = manifests.groupBy("scrape_prefix").agg(F.max("timestamp").alias("scraped_at"))
    located = (
        staged.join(listed, ["scrape_prefix", "file_name"], "left")
        .withColumn("url", F.coalesce("_url", "file_name"))
        .drop("_url")
    )
    # One scrape may hold a large share of all files.
    return salted_join(located, times, ["scrape_prefix"], ["file_name"], how="left")
