"""Dense numbers for the rows of a large table."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut_lineage

#: Bits of ``monotonically_increasing_id`` that count the rows of a task.
_ROW_BITS = 33


def dense_numbers(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``df`` with ``name``, the place of each row in ``order``, from 0 on.

    Rows are sorted by ranges; only a count per task, a row each, is summed up in one.
    """
    ordered = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    task = F.shiftright("_row", _ROW_BITS)
    counts = ordered.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_task")) - F.col("_n")
    starts = F.broadcast(counts.select("_task", before.alias("_start")))
    place = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ordered.withColumn("_task", task)
        .join(starts, "_task")
        .withColumn(name, F.col("_start") + place)
        .drop("_row", "_task", "_start")
    )
