"""Preference for the Markdown form of a page."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import detect_markdown, markdown_url_variants
from ..plans import salted_join


def prefer_markdown_variant(pages: DataFrame, fetched: DataFrame | None = None) -> DataFrame:
    """Give a page the body and content type of its Markdown variant, if fetched.

    A variant counts when its status is 200 and it is detected as Markdown; the
    first in the order of ``markdown_url_variants`` wins. The page keeps its own
    URL and every other column. ``fetched`` defaults to the pages themselves.

    Only variant URLs that some page asks for are looked up, each once, so that a
    URL held by very many rows is not joined row by row; the found bodies return
    to the pages in a join salted on such URLs.
    """
    fetched = pages if fetched is None else fetched
    asked = (
        pages.select("url")
        .distinct()
        .select("url", F.posexplode(markdown_url_variants("url")).alias("_pos", "_variant"))
    )
    markdown = fetched.where(
        (F.col("status") == 200) & detect_markdown("url", "content_type", "body")
    ).select(
        F.col("url").alias("_variant"),
        F.struct("content_type", "body").alias("_page"),
    )
    # Copies of a URL: the least page wins, found with partial aggregation.
    answers = (
        salted_join(markdown, asked.select("_variant").distinct(), ["_variant"], ["_page"])
        .groupBy("_variant")
        .agg(F.min("_page").alias("_page"))
    )
    chosen = (
        asked.join(answers, "_variant")
        .groupBy("url")
        .agg(F.min_by("_page", "_pos").alias("_page"))
    )
    joined = salted_join(pages, chosen, ["url"], ["body"], how="left")
    replaced = {
        "content_type": F.when(F.col("_page").isNull(), F.col("content_type")).otherwise(
            F.col("_page.content_type")
        ),
        "body": F.when(F.col("_page").isNull(), F.col("body")).otherwise(F.col("_page.body")),
    }
    return joined.withColumns(replaced).select(*pages.columns)
