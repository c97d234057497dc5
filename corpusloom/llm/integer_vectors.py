"""Vectors of whole numbers: what takes part, blocks of queries, best rows per group."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import work_table

#: Sums of products below these are exact in 32-bit and 64-bit floating point.
_EXACT = {"float": 2**24, "double": 2**53}
#: Queries that one scan of the vectors carries.
BLOCK_QUERIES = 4096


@dataclass(frozen=True)
class IntegerVectors:
    """``rows``: ``id``, ``label`` and ``vector``, one row per id, whole numbers.

    ``rows`` is a written table; ``kind`` is the floating type in which all inner
    products are exact.
    """

    rows: DataFrame
    n_rows: int
    dims: int
    kind: str

    @property
    def dtype(self) -> type:
        return np.float32 if self.kind == "float" else np.float64


def integer_vectors(
    df: DataFrame, factor: int, id_col: str, vector_col: str, label: F.Column | None = None
) -> IntegerVectors:
    """Rows that take part, each component ``x`` replaced by ``floor(factor * x)``.

    Left out are rows whose id, vector or label is null or whose vector holds a null or
    non-finite component. Ids are whole numbers; of several rows with one id, that with the smallest
    (vector, label) counts. A vector shorter than the longest counts as ending in zeros.
    Components so large that a sum of products may reach ``2**53`` raise ``ValueError``.
    """
    infinite = F.lit(float("inf"))
    held = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)
    )
    named = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        (F.lit(0) if label is None else label).cast("long").alias("label"),
    )
    scaled = F.transform("vector", lambda x: F.floor(x * factor).cast("double"))
    usable = named.where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & F.col("label").isNotNull() & held
    ).select("id", F.struct(scaled.alias("vector"), "label").alias("row"))
    # A task keeps one row per id before the shuffle, so that a repeated id is not hot.
    once = usable.groupBy("id").agg(F.min("row").alias("row"))
    rows = work_table(once.select("id", "row.label", "row.vector"))
    largest = F.array_max(F.transform("vector", F.abs))
    n_rows, dims, most = rows.agg(
        F.count(F.lit(1)), F.max(F.size("vector")), F.max(largest)
    ).first()
    bound = (dims or 0) * (most or 0.0) ** 2
    kind = next((name for name, limit in _EXACT.items() if bound < limit), None)
    if kind is None:
        raise ValueError(f"components up to {most:g} leave the exact range of inner products")
    return IntegerVectors(rows, n_rows, dims or 0, kind)


def as_matrix(column: pa.Array, dims: int, dtype: type) -> np.ndarray:
    """The vectors of an Arrow list column as rows, short ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    if len(values) == len(column) * dims:
        return values.reshape(len(column), dims)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    filled = np.zeros((len(column), dims), dtype)
    filled[np.arange(dims) < sizes[:, None]] = values
    return filled


def query_blocks(
    vectors: IntegerVectors, queries: DataFrame, size: int = BLOCK_QUERIES
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``block, ids, labels, matrix`` of the queries, about ``size`` at a time.

    ``queries`` are rows of ``vectors``. Blocks are dealt by a hash of the id, so each
    is bounded; one at a time passes through the driver.
    """
    n_blocks = -(-queries.count() // size)
    if not n_blocks:
        return
    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")
    dealt = work_table(queries.withColumn("block", block), partition_by=["block"])
    for number in range(n_blocks):
        table = dealt.where(F.col("block") == number).select("id", "label", "vector").toArrow()
        if table.num_rows:
            matrix = as_matrix(table.column("vector"), vectors.dims, vectors.dtype)
            yield number, table.column("id").to_numpy(), table.column("label").to_numpy(), matrix


class BestRows:
    """The ``limit`` best (score, id) of each of ``groups`` groups; ties to smaller ids."""

    def __init__(self, groups: int, limit: int, known: np.ndarray | None = None):
        self.limit = limit
        self.scores = np.full((groups, limit), -np.inf)
        self.ids = np.full((groups, limit), np.iinfo(np.int64).max)
        #: What a row must reach to count: the last of a full group, or a score known
        #: to be reached by ``limit`` rows elsewhere.
        self.border = np.full(groups, -np.inf) if known is None else known.copy()

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Rows in any order; many rows of one group cost memory for all groups."""
        good = score >= self.border[group]
        group, score, ids = group[good], score[good], ids[good]
        if not len(group):
            return
        order = np.argsort(group, kind="stable")
        group, score, ids = group[order], score[order], ids[order]
        touched, first, counts = np.unique(group, return_index=True, return_counts=True)
        row = np.repeat(np.arange(len(touched)), counts)
        at = self.limit + np.arange(len(group)) - np.repeat(first, counts)
        width = self.limit + int(counts.max())
        scores = np.full((len(touched), width), -np.inf)
        names = np.full((len(touched), width), np.iinfo(np.int64).max)
        scores[:, : self.limit], names[:, : self.limit] = self.scores[touched], self.ids[touched]
        scores[row, at], names[row, at] = score, ids
        best = np.lexsort((names, -scores), axis=1)[:, : self.limit]
        self.scores[touched] = np.take_along_axis(scores, best, 1)
        self.ids[touched] = np.take_along_axis(names, best, 1)
        self.border[touched] = np.maximum(self.border[touched], self.scores[touched, -1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``group, score, id`` of all that is held."""
        group, place = np.nonzero(self.scores > -np.inf)
        return group, self.scores[group, place].astype(np.int64), self.ids[group, place]
