"""Row errors and run counters."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)`` by the ``error`` column; good rows lose it."""
    return rows.where(F.col("error").isNull()).drop("error"), rows.where(
        F.col("error").isNotNull()
    )


def run_metrics(rows: DataFrame, prefix_col: str = "scrape_prefix") -> DataFrame:
    """Pages, indexed documents and errors per scrape."""
    return rows.groupBy(prefix_col).agg(*_counters())


def run_totals(rows: DataFrame, prefix_col: str = "scrape_prefix") -> DataFrame:
    """``run_metrics`` and one row with a null prefix for the whole run."""
    return rows.rollup(prefix_col).agg(*_counters())


def _counters():
    return [
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("error").isNull()).alias("docs_indexed"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
    ]
