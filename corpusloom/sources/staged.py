"""Staged scrapes: trees of Markdown objects, the Parquet layout, manifests."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MANIFEST_SCHEMA

STAGED_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("scrape_prefix", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("run", T.StringType()),
    ]
)

_PREFIX_OF_PAGE = r"(scrapes/[^/]+/[^/]+)/pages/"
_PREFIX_OF_MANIFEST = r"(scrapes/[^/]+/[^/]+)/metadata\.json$"


def _decoded_path():
    """``_metadata.file_path`` is percent-encoded; a plus sign in it is literal."""
    return F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))


def scan_staged_pages(
    spark: SparkSession, root: str, prefix: str | list[str] | None = None
) -> DataFrame:
    """Every ``.md`` object below ``{prefix}/pages/``, one row per whole object."""
    prefixes = [prefix] if isinstance(prefix, str) else prefix
    paths = [f"{root}/{p}/pages" for p in prefixes] if prefixes else [f"{root}/scrapes"]
    text = spark.read.text(
        paths, wholetext=True, pathGlobFilter="*.md", recursiveFileLookup=True
    )
    return text.select(
        F.regexp_extract(_decoded_path(), _PREFIX_OF_PAGE, 1).alias("scrape_prefix"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("value").alias("content"),
    )


def scan_staged_table(
    spark: SparkSession, root: str, scrapes: str | DataFrame | None = None
) -> DataFrame:
    """Pages written by ``stage_pages``, of all scrapes, of one, or of a table of
    them with a ``scrape_prefix`` column.

    One prefix becomes a partition filter; a table of prefixes a semi join on the
    partition columns, which dynamic partition pruning turns into one.
    """
    staged = spark.read.schema(STAGED_SCHEMA).parquet(f"{root}/staged")
    if scrapes is None:
        return staged
    if isinstance(scrapes, str):
        _, host, run = scrapes.split("/", 2)
        return staged.where((F.col("host") == host) & (F.col("run") == run))
    parts = F.split("scrape_prefix", "/")
    wanted = scrapes.select(
        F.get(parts, F.lit(1)).alias("host"), F.get(parts, F.lit(2)).alias("run")
    ).distinct()
    return staged.join(wanted, ["host", "run"], "left_semi")


def manifest_columns(manifests: DataFrame) -> DataFrame:
    """Fill the fields that single-part manifests leave out."""
    found = F.regexp_extract(_decoded_path(), _PREFIX_OF_MANIFEST, 1)
    return manifests.select(
        "source_url",
        "timestamp",
        "page_count",
        "pages",
        F.coalesce("scrape_prefix", F.nullif(found, F.lit(""))).alias("scrape_prefix"),
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("parts", F.lit(1)).alias("parts"),
    )


def read_manifests(
    reader, root: str, layout: str, prefix: str | None = None, recursive: bool = False
) -> DataFrame:
    """Manifest rows through a batch or a streaming reader.

    ``tree``: one, possibly indented, JSON object per ``metadata.json``. The glob
    lists the run folders only, never the page objects below them; it cannot pass
    a folder whose name holds a colon (a host with a port), for which
    ``recursive`` lists everything below ``scrapes``.
    ``table``: JSON lines written by ``write_manifests``.
    """
    reader = reader.schema(MANIFEST_SCHEMA).option("multiLine", layout == "tree")
    if layout == "table":
        path = f"{root}/manifests"
    elif prefix is None and recursive:
        path = f"{root}/scrapes"
        reader = reader.option("recursiveFileLookup", True).option(
            "pathGlobFilter", "metadata.json"
        )
    else:
        path = f"{root}/{prefix or 'scrapes/*/*'}/metadata.json"
    return manifest_columns(reader.json(path))


def scan_manifests(
    spark: SparkSession,
    root: str,
    prefix: str | None = None,
    layout: str = "tree",
    recursive: bool = False,
) -> DataFrame:
    """All manifest rows below ``root``, or those of one scrape."""
    rows = read_manifests(spark.read, root, layout, prefix, recursive)
    return rows if prefix is None else rows.where(F.col("scrape_prefix") == prefix)
