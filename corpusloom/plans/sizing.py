"""Size checks that decide between a broadcast and a shuffle."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def is_bounded(
    df: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> bool:
    """Measure ``df`` with one distributed aggregate and compare with the bound.

    Bytes are taken from the JSON form of each row, an upper estimate of what a
    broadcast ships for the string and array columns used here.
    """
    row_bytes = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    n_rows, n_bytes = df.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(row_bytes), F.lit(0))
    ).first()
    return n_rows <= max_rows and n_bytes <= max_bytes


def broadcast_if_bounded(
    df: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when the measured size allows it, else ``(df, False)``."""
    if is_bounded(df, max_rows, max_bytes):
        return F.broadcast(df), True
    return df, False


def spread_scan(df: DataFrame) -> DataFrame:
    """Redistribute a scan that has fewer splits than the cluster has cores.

    Large inputs already have more splits than cores and are returned untouched;
    only small files (few row groups, CPU-heavy rows) pay the exchange.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
