"""Nearest neighbours by cosine similarity."""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..plans import cut_lineage
from .bm25 import DEFAULT_LIMIT, SCORE_DIGITS, check_limit, top_per_query

#: Queries that one scan of the vectors carries.
QUERIES_PER_BLOCK = 1024
#: Bytes of scores (rows * queries * 8) that a task holds at once.
SCORE_BYTES = 32 << 20
#: Rows, chosen by a hash of their id, from which the cells of an index are learned.
TRAINING_ROWS = 20_000


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix.astype(np.float64)
    with np.errstate(invalid="ignore", divide="ignore"):
        return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


class _TopPerQuery:
    """Running best ``limit`` hits of each query over batches of vectors."""

    def __init__(self, query_ids: Sequence, queries: np.ndarray, limit: int):
        self.query_ids = query_ids
        self.unit_queries = _unit_rows(queries)
        self.limit = limit
        self.best = [(np.empty(0), np.empty(0, dtype=object)) for _ in query_ids]

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, SCORE_BYTES // (8 * max(1, len(self.best))))
        for first in range(0, len(ids), step):
            self._add(ids[first : first + step], vectors[first : first + step])

    def _add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        scores = np.round(_unit_rows(vectors) @ self.unit_queries.T, SCORE_DIGITS)
        for q, (best_scores, best_ids) in enumerate(self.best):
            column = scores[:, q]
            # A zero vector has no direction and never matches.
            at = np.flatnonzero(~np.isnan(column))
            if len(at) > self.limit:
                # All entries as good as the limit-th one stay: ids settle ties.
                border = np.partition(column[at], len(at) - self.limit)[len(at) - self.limit]
                at = at[column[at] >= border]
            merged = np.concatenate([best_scores, column[at]])
            names = np.concatenate([best_ids, ids[at].astype(object)])
            by_id = np.argsort(names, kind="stable")
            order = by_id[np.argsort(-merged[by_id], kind="stable")][: self.limit]
            self.best[q] = (merged[order], names[order])

    def hits(self) -> dict[str, list]:
        return {
            "query_id": [q for q, (s, _) in zip(self.query_ids, self.best) for _ in s],
            "id": [name for _, names in self.best for name in names],
            "score": [float(s) for scores, _ in self.best for s in scores],
        }


def _scan(
    vectors: DataFrame, query_ids: list, query_type: T.DataType, matrix: np.ndarray, limit: int
) -> DataFrame:
    """One pass over ``id, vector`` with a bounded block of queries at hand.

    A task multiplies its Arrow batches with the query matrix and returns at most
    ``limit`` rows per query; pairs of query and vector never leave it.
    """
    shared = vectors.sparkSession.sparkContext.broadcast((query_ids, matrix))
    id_type = vectors.schema["id"].dataType.simpleString()
    result = pa.schema(
        [
            ("query_id", to_arrow_type(query_type)),
            ("id", to_arrow_type(vectors.schema["id"].dataType)),
            ("score", pa.float64()),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries = shared.value
        top = _TopPerQuery(names, queries, limit)
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                top.add(ids, flat.reshape(batch.num_rows, -1))
        yield pa.RecordBatch.from_pydict(top.hits(), schema=result)

    return vectors.mapInArrow(scan, f"query_id {query_type.simpleString()}, id {id_type}, score double")


def _usable(documents: DataFrame, dims: int, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` of the documents that have a vector of the right size."""
    return documents.where(F.size(vector_col) == dims).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<float>").alias("vector")
    )


def knn(
    documents: DataFrame,
    vector: Sequence[float],
    limit: int = DEFAULT_LIMIT,
    id_col: str = "id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``rank, id, score`` of the exact nearest documents to one vector.

    Documents without a vector, or with one of another size, never match.
    """
    check_limit(limit)
    usable = _usable(documents, len(vector), id_col, vector_col)
    if limit == 0:
        return usable.select(F.lit(0).alias("rank"), "id", F.lit(0.0).alias("score")).limit(0)
    matrix = np.asarray([vector], dtype=np.float64)
    found = _scan(usable, ["q"], T.StringType(), matrix, limit)
    top = found.orderBy(F.desc("score"), "id").limit(limit)
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return top.withColumn("rank", F.row_number().over(window)).select("rank", "id", "score")


def knn_many(
    documents: DataFrame,
    queries: DataFrame,
    limit: int = DEFAULT_LIMIT,
    id_col: str = "id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, id, score`` for every row of ``queries`` with a vector."""
    check_limit(limit)
    queries = cut_lineage(
        queries.where(F.col("query_embedding").isNotNull()).select("query_id", "query_embedding")
    )
    n_queries, dims, max_dims = queries.agg(
        F.count(F.lit(1)), F.min(F.size("query_embedding")), F.max(F.size("query_embedding"))
    ).first()
    if dims != max_dims:
        raise ValueError("query vectors differ in size")
    usable = _usable(documents, dims or 0, id_col, vector_col)
    query_type = queries.schema["query_id"].dataType
    if limit == 0 or n_queries == 0:
        return usable.select(
            F.lit(None).cast(query_type).alias("query_id"),
            F.lit(0).alias("rank"),
            "id",
            F.lit(0.0).alias("score"),
        ).limit(0)
    # Each block of queries is one scan; blocks are bounded whatever their number.
    n_blocks = -(-n_queries // QUERIES_PER_BLOCK)
    block = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks))
    found = None
    for number in range(n_blocks):
        rows = queries.where(block == number).collect() if n_blocks > 1 else queries.collect()
        if rows:
            matrix = np.array([r["query_embedding"] for r in rows], dtype=np.float64)
            hits = _scan(usable, [r["query_id"] for r in rows], query_type, matrix, limit)
            found = hits if found is None else found.unionByName(hits)
    return top_per_query(found, limit).select("query_id", "rank", "id", "score")


@dataclass(frozen=True)
class VectorIndex:
    """``vectors`` (``id, vector, cell``), the unit centre, size and reach of each cell.

    ``reach`` is the smallest cosine of a vector of the cell with its centre, -1 where
    that is not known.

    Written with :func:`write_vector_index`, ``vectors`` is partitioned by ``cell``, so
    that a search reads the partitions of its cells only.
    """

    vectors: DataFrame
    centres: np.ndarray
    sizes: np.ndarray
    reach: np.ndarray | None = None


def _nearest_cell(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.nan_to_num(_unit_rows(vectors) @ centres.T, nan=-2.0).argmax(axis=1)


def build_vector_index(
    documents: DataFrame,
    dims: int,
    n_cells: int = 64,
    id_col: str = "id",
    vector_col: str = "embedding",
    rounds: int = 8,
) -> VectorIndex:
    """Put every vector into the cell of its nearest centre.

    The centres are learned (spherical k-means) from at most ``TRAINING_ROWS`` rows;
    every row is indexed.
    """
    usable = _usable(documents, dims, id_col, vector_col)
    sample = usable.orderBy(F.xxhash64("id"), "id").limit(TRAINING_ROWS).select("vector")
    rows = _unit_rows(np.array([r[0] for r in sample.collect()], dtype=np.float64).reshape(-1, dims))
    rows = rows[~np.isnan(rows).any(axis=1)]
    centres = rows[:: max(1, len(rows) // n_cells)][:n_cells]
    centres = centres if len(centres) else np.zeros((1, dims))
    for _ in range(rounds):
        cell = _nearest_cell(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, rows)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(lengths > 0, sums / np.maximum(lengths, 1e-12), centres)

    @F.pandas_udf("cell int, near double")
    def place_of(vectors: pd.Series) -> pd.DataFrame:
        if vectors.empty:
            return pd.DataFrame({"cell": np.zeros(0, "int32"), "near": np.zeros(0)})
        matrix = np.stack(vectors)
        cell = _nearest_cell(matrix, centres)
        near = (_unit_rows(matrix) * centres[cell]).sum(axis=1)
        # A zero vector has no direction; it never matches and widens no cell.
        return pd.DataFrame({"cell": cell.astype("int32"), "near": np.nan_to_num(near, nan=1.0)})

    placed = cut_lineage(usable.withColumn("place", place_of("vector")))
    counted = placed.groupBy("place.cell").agg(F.count(F.lit(1)), F.min("place.near")).collect()
    sizes = np.zeros(len(centres), dtype=np.int64)
    reach = np.ones(len(centres))
    for cell, size, near in counted:
        sizes[cell], reach[cell] = size, near
    return VectorIndex(placed.select("id", "vector", "place.cell"), centres, sizes, reach)


def write_vector_index(index: VectorIndex, root: str) -> None:
    spark = index.vectors.sparkSession
    index.vectors.hint("rebalance", "cell").write.partitionBy("cell").mode("overwrite").parquet(
        f"{root}/vectors"
    )
    reach = np.full(len(index.sizes), -1.0) if index.reach is None else index.reach
    cells = [
        (n, c.tolist(), int(s), float(r))
        for n, (c, s, r) in enumerate(zip(index.centres, index.sizes, reach))
    ]
    schema = "number int, centre array<double>, size long, reach double"
    spark.createDataFrame(cells, schema).coalesce(1).write.mode("overwrite").parquet(
        f"{root}/cells"
    )


def open_vector_index(spark: SparkSession, root: str) -> VectorIndex:
    cells = sorted(spark.read.parquet(f"{root}/cells").collect())
    return VectorIndex(
        spark.read.parquet(f"{root}/vectors"),
        np.array([row["centre"] for row in cells]),
        np.array([row["size"] for row in cells]),
        np.array([row["reach"] for row in cells]) if cells and "reach" in cells[0] else None,
    )


def knn_approx(
    index: VectorIndex,
    vector: Sequence[float],
    limit: int = DEFAULT_LIMIT,
    n_probe: int | None = None,
) -> DataFrame:
    """``rank, id, score`` of the nearest vectors in the nearest cells.

    By default the nearest cells that hold ``limit`` vectors are read first, then every
    cell that can hold a better one: by its reach, the largest cosine of a vector in it
    is known, so that none of the nearest is missed. With ``n_probe``, that many of
    the nearest cells are read, and further ones only until those read hold ``limit``
    vectors; then some may be missed. Scores are exact.
    """
    check_limit(limit)
    key = _unit_rows(np.asarray([vector], dtype=np.float64))[0]
    order = np.argsort(-np.nan_to_num(index.centres @ key), kind="stable")
    held = np.cumsum(index.sizes[order])
    needed = int(np.searchsorted(held, min(limit, held[-1]))) + 1
    cells = order[: max(n_probe or 1, needed)].tolist()
    if n_probe is None and limit:
        cells = _safe_cells(index, key, vector, limit, cells)
    near = index.vectors.where(F.col("cell").isin(*cells))
    return knn(near, vector, limit, "id", "vector")


def _safe_cells(
    index: VectorIndex, key: np.ndarray, vector: Sequence[float], limit: int, cells: list[int]
) -> list[int]:
    """``cells`` and all that can hold a vector as near as the worst found in ``cells``."""
    everything = np.flatnonzero(index.sizes).tolist()
    if index.reach is None or np.isnan(key).any() or not everything:
        return everything or cells
    near = index.vectors.where(F.col("cell").isin(*cells))
    scores = [row["score"] for row in knn(near, vector, limit, "id", "vector").collect()]
    if len(scores) < limit:
        return everything
    # The angle to a vector is at least that to its centre less the cell's own.
    centre = np.arccos(np.clip(_unit_rows(index.centres) @ key, -1, 1))
    own = np.arccos(np.clip(index.reach / np.linalg.norm(index.centres, axis=1), -1, 1))
    best = np.cos(np.maximum(centre - own, 0))
    # Rounding may not exclude a vector; a centre without direction excludes none.
    able = ~(best < min(scores) - 1e-6) & (index.sizes > 0)
    return sorted({*cells, *np.flatnonzero(able).tolist()})
