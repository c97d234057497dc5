"""Hard negatives by slots of scores.

Each positive of an anchor asks for the best negatives inside a window of scores below
its own. The upper limits of an anchor's windows, in descending order, part the scores into
disjoint slots: slot ``s`` reaches from limit ``s`` down to the next one. A negative lies in
one slot only. Tasks keep the best rows per anchor and slot over all rows they scan, and
the shuffle carries only those. Merged from the lowest slot upwards, the lists give, for
each slot, the best of all scores below its limit, which answers every window that begins
there; its lower limit then cuts the list.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import work_path, work_table
from .integer_vectors import BestRows, IntegerVectors, as_matrix, integer_vectors, query_blocks

#: Rows that are compared with a block of anchors at once, and anchors in a block.
STEP_ROWS = 512
BLOCK_ANCHORS = 512

_FOUND = "anchor_id long, slot int, id long, score long"


def _scan(vectors: IntegerVectors, anchors: tuple, limits, k: int) -> DataFrame:
    """``anchor_id, slot, id, score``: at most ``k`` rows per anchor, slot and task.

    Without ``limits`` there is one slot, of the rows of the anchor's label. Else
    ``limits`` holds the upper limits of each anchor, descending, and its least lower one;
    rows of other labels count.
    """
    shared = vectors.rows.sparkSession.sparkContext.broadcast((*anchors, limits))
    dims, dtype = vectors.dims, vectors.dtype
    schema = pa.schema(
        [("anchor_id", pa.int64()), ("slot", pa.int32()), ("id", pa.int64()), ("score", pa.int64())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, labels, matrix, limits = shared.value
        n_slots = 1 if limits is None else limits[0].shape[1]
        best = BestRows(len(names) * n_slots, k)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(at, STEP_ROWS)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                rows = as_matrix(part.column(2), dims, dtype)
                same = labels[:, None] == part.column(1).to_numpy(zero_copy_only=False)
                scores = matrix @ rows.T
                if limits is None:
                    slot = np.zeros(scores.shape, np.int64)
                    good = same & (names[:, None] != ids)
                else:
                    # Slot s: at or below limit s, above limit s + 1.
                    upper, lower = limits
                    slot = (scores[:, :, None] <= upper[:, None, :]).sum(axis=2) - 1
                    good = ~same & (slot >= 0) & (scores >= lower[:, None])
                anchor, column = np.nonzero(good)
                group = anchor * n_slots + slot[anchor, column]
                best.add(group, scores[anchor, column], ids[column])
        group, score, found = best.rows()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names[group // n_slots]),
                pa.array((group % n_slots + 1).astype(np.int32)),
                pa.array(found),
                pa.array(score),
            ],
            schema=schema,
        )

    return vectors.rows.select("id", "label", "vector").mapInArrow(scan, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows per anchor and slot, over all tasks."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _limits(windows: DataFrame, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper limits by slot (none: below all scores) and the least lower one per anchor."""
    rows = (
        windows.groupBy("anchor_id", "slot")
        .agg(F.max("high").alias("high"), F.min("low").alias("low"))
        .collect()
    )
    n_slots = max((row["slot"] for row in rows), default=1)
    upper = np.full((len(ids), n_slots), -np.inf)
    lower = np.full(len(ids), np.inf)
    at = {int(name): n for n, name in enumerate(ids)}
    for row in rows:
        n = at[row["anchor_id"]]
        upper[n, row["slot"] - 1] = row["high"]
        lower[n] = min(lower[n], row["low"])
    return upper, lower


def _suffix_merges(windows: DataFrame, slots: DataFrame, k: int) -> DataFrame:
    """Negatives of each window: lists of slots merged from the lowest upwards."""
    of_anchor = windows.groupBy("anchor_id").agg(
        F.collect_list(F.struct("slot", "positive_id", "positive_score", "low")).alias("windows")
    )
    # At most k rows per slot, and as many slots as an anchor has positives.
    rows = slots.groupBy("anchor_id").agg(
        F.collect_list(F.struct("slot", (-F.col("score")).alias("minus"), "id")).alias("rows")
    )
    both = of_anchor.join(rows, "anchor_id").withColumn(
        "n", F.array_max(F.transform("windows", lambda w: w["slot"]))
    )
    merged = F.expr(
        f"""
        aggregate(
            sequence(n, 1, -1),
            cast(array() as array<array<struct<minus: bigint, id: bigint>>>),
            (lists, s) -> concat(lists, array(slice(array_sort(concat(
                coalesce(get(lists, size(lists) - 1),
                    cast(array() as array<struct<minus: bigint, id: bigint>>)),
                transform(filter(rows, r -> r.slot = s),
                    r -> named_struct('minus', r.minus, 'id', r.id))
            )), 1, {k})))
        )"""
    )
    answered = (
        both.select("anchor_id", "n", F.explode("windows").alias("w"), merged.alias("merged"))
        .select(
            "anchor_id",
            "w.positive_id",
            "w.positive_score",
            F.expr("filter(get(merged, n - w.slot), r -> r.minus <= -w.low)").alias("list"),
        )
        .select("anchor_id", "positive_id", "positive_score", F.posexplode("list").alias("at", "r"))
    )
    return answered.select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).alias("rank"),
        F.col("r.id").alias("negative_id"),
        "positive_score",
        (-F.col("r.minus")).alias("negative_score"),
    )


def hard_negatives(
    df: DataFrame,
    anchors: F.Column,
    label: F.Column,
    factor: int = 1,
    n_positives: int = 5,
    n_negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on ``id``. An anchor's positives are the ``n_positives``
    other rows of its label with the largest inner product; the negatives of each are
    the ``n_negatives`` best rows of other labels with ``low_percent`` to ``high_percent`` of the
    positive's score. Equal scores go by smaller id; where fewer rows qualify, all are
    returned. A positive with a negative score has no negatives, one of 0 those of 0. What
    takes part and what becomes of repeated ids and vectors of unequal length is said in
    :func:`integer_vectors`. An empty table gives no rows.
    """
    if not 0 <= low_percent <= high_percent:
        raise ValueError("need 0 <= low_percent <= high_percent")
    spark = df.sparkSession
    vectors = integer_vectors(df, factor, id_col, vector_col, label)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    path = work_path(spark)
    last = None
    by_limit = Window.partitionBy("anchor_id").orderBy(F.desc("high"))
    for block, ids, labels, matrix in query_blocks(
        vectors, vectors.rows.where(anchors), BLOCK_ANCHORS
    ):
        positives = _best(_scan(vectors, (ids, labels, matrix), None, n_positives), n_positives)
        windows = (
            positives.where("score >= 0")
            .select(
                "anchor_id",
                F.col("id").alias("positive_id"),
                F.col("score").alias("positive_score"),
                F.expr(f"score * {high_percent} div 100").alias("high"),
                F.expr(f"(score * {low_percent} + 99) div 100").alias("low"),
            )
            .withColumn("slot", F.dense_rank().over(by_limit))
        )
        windows.write.parquet(f"{path}/windows/{block}")
        windows = spark.read.schema(windows.schema).parquet(f"{path}/windows/{block}")
        found = _scan(vectors, (ids, labels, matrix), _limits(windows, ids), n_negatives)
        found.write.parquet(f"{path}/slots/{block}")
        last = windows.schema, found.schema
    if last is None:
        return spark.createDataFrame([], schema)
    windows = spark.read.schema(last[0]).parquet(f"{path}/windows/*")
    slots = work_table(_best(spark.read.schema(last[1]).parquet(f"{path}/slots/*"), n_negatives))
    return _suffix_merges(windows, slots, n_negatives)
