"""Joins that survive one key holding a large share of the rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000
MAX_SPLITS = 2_000


def hot_keys(
    counts: DataFrame,
    keys: list[str],
    count_col: str,
    hot_rows: int = HOT_ROWS,
    max_splits: int = MAX_SPLITS,
) -> DataFrame:
    """Keys heavier than ``hot_rows`` and the number of salts each one gets.

    ``counts`` has one row per key. At most ``MAX_HOT_KEYS`` rows come back, which
    bounds the broadcast; a key outside that list holds at most 1/``MAX_HOT_KEYS``
    of all rows and needs no salt, so nothing is lost by the bound.
    """
    splits = F.least(F.ceil(F.col(count_col) / hot_rows), F.lit(max_splits)).cast("int")
    return (
        counts.where(F.col(count_col) > hot_rows)
        .orderBy(F.desc(count_col), *keys)
        .limit(MAX_HOT_KEYS)
        .select(*keys, splits.alias("_splits"))
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread_by: list[str],
    hot: DataFrame | None = None,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join a skewed ``left`` with a ``right`` that is small per key.

    Rows of a hot key on the left are split over several salts derived from
    ``spread_by``; the matching right rows are repeated once per salt. Works for
    inner, left and left_semi joins. ``hot`` (from :func:`hot_keys`) is computed
    from the left side when the caller has no counts at hand.
    """
    if hot is None:
        counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        hot = hot_keys(counts, keys, "_n", hot_rows)
    hot = F.broadcast(hot)
    salt: Column = F.pmod(F.xxhash64(*spread_by), F.coalesce("_splits", F.lit(1))).cast("int")
    salted_left = left.join(hot, keys, "left").withColumn("_salt", salt).drop("_splits")
    salted_right = (
        right.join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1)),
        )
        .drop("_splits")
    )
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order.

    The rank filter also prunes every input partition before the shuffle, so a key
    with very many rows sends one row per partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )
