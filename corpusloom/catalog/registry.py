"""Registration of named queries over the test tables."""

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import shared_dir, spread_scan
from ..sinks.versions import hadoop_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL if it has one, under ``name`` or its own name."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, what: str) -> str:
    """A folder for what queries write once in an application and read many times.

    It lies in the shared checkpoint folder and goes when the application ends.
    """
    context = spark.sparkContext
    root = f"{shared_dir(spark).rstrip('/')}/corpusloom-{context.applicationId}"
    if getattr(context, "_corpusloom_root", None) != root:
        system, folder = hadoop_path(spark, root)
        system.mkdirs(folder)
        system.deleteOnExit(folder)
        context._corpusloom_root = root
    return f"{root}/{hashlib.sha256(what.encode()).hexdigest()[:16]}"


def pages_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetched pages in the page schema, plus ``page_id``."""
    raw = spread_scan(table(spark, sf_dir, "pages"))
    return raw.select(
        "page_id",
        "url",
        F.lit(200).alias("status"),
        F.lit("text/html").alias("content_type"),
        F.col("html").alias("body"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id")).alias("scraped_at"),
    )


def documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with their text as ``content``."""
    raw = spread_scan(table(spark, sf_dir, "documents"))
    return raw.select(F.col("doc_id").alias("id"), F.col("text").alias("content"), "lang", "source")


# Pieces of SQL shared by the checks.
WORDS = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+')"
_WS = (
    "[\\x{09}-\\x{0D}\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"
)


def words(expr: str) -> str:
    return WORDS.format(expr)


def trim(expr: str) -> str:
    return f"regexp_replace({expr}, '^{_WS}|{_WS}$', '', 'g')"


def document_id(expr: str) -> str:
    return f"substr(sha256({expr}), 1, 16)"


def host(expr: str) -> str:
    return f"regexp_extract({expr}, '://(?:[^/?#@]*@)?([^/?#]*)', 1)"
