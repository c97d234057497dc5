"""Connected components by column functions and joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import cut_lineage

#: Links per task: few links are not dealt over all partitions of a shuffle.
TASK_LINKS = 100_000


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for edges ``a``, ``b``.

    Alternates two steps until nothing changes: every node links its larger
    neighbours to its smallest one, then its smaller neighbours and itself. Each
    step sums per task before its shuffle and at most doubles no list anywhere; the
    number of rounds grows with the logarithm of the largest component. Edges may be
    repeated or given in either direction; loops and nulls are left out.
    """
    links = (
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    links = cut_lineage(links)
    state = _fingerprint(links)
    while True:
        tasks = state[0] // TASK_LINKS + 1
        links = cut_lineage(_small_star(_large_star(links, tasks), tasks))
        now = _fingerprint(links)
        if now == state:
            break
        state = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _fingerprint(links: DataFrame):
    """Number of links and a sum over their hashes that no order changes."""
    half = F.shiftright(F.xxhash64("u", "v"), 24)
    return tuple(links.agg(F.count(F.lit(1)), F.sum(half.cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame, tasks: int) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(tasks)
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u != v")
        .distinct()
    )


def _small_star(links: DataFrame, tasks: int) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = (
        links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.union(least.select("u", F.col("m").alias("v"))).coalesce(tasks).distinct()
