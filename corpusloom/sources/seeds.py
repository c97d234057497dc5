"""Choice of crawl seeds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_sources(sources: DataFrame, name: str | None = None, url: str | None = None) -> DataFrame:
    """Seed URLs: an explicit URL wins, else the named source, else all.

    Sources without a URL are skipped. Having nothing left is an error.
    """
    if url:
        return sources.sparkSession.createDataFrame([(None, url)], "name string, url string")
    if sources.isEmpty():
        raise ValueError("no sources given and no url")
    chosen = sources.where(F.col("url") != "").select("name", "url")
    if name:
        chosen = chosen.where(F.col("name") == name)
    if chosen.isEmpty():
        raise ValueError(f"no source named {name!r} with a url" if name else "no source has a url")
    return chosen
