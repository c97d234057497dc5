"""Fetched pages and finished documents as tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DOCUMENT_SCHEMA, PAGE_SCHEMA


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """Crawl output that already has the page schema."""
    return spark.read.schema(PAGE_SCHEMA).parquet(path)


def pages_from_table(df: DataFrame, url: str = "url", body: str = "body", **columns) -> DataFrame:
    """Project any table of fetched pages to the page schema.

    ``columns`` may give ``status``, ``content_type`` and ``scraped_at`` as Columns;
    a table that records none holds successful fetches of unknown type.
    """
    defaults = {
        "status": F.lit(200),
        "content_type": F.lit(""),
        "scraped_at": F.lit(None),
    }
    exprs = {"url": F.col(url), "body": F.col(body), **defaults, **columns}
    return df.select(
        *[exprs[field.name].cast(field.dataType).alias(field.name) for field in PAGE_SCHEMA]
    )


def scan_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(DOCUMENT_SCHEMA).parquet(*paths)


def drop_http_errors(pages: DataFrame) -> DataFrame:
    """Keep responses with a status below 400."""
    return pages.where(F.col("status") < 400)
