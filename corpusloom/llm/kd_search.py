"""Exact search for the largest inner products by a KD-tree per shard.

Rows are dealt to shards of bounded bytes by a hash of their id. Each shard is a
KD-tree: nodes are split at the median of the component that spreads most, and every node
keeps the tight box of its rows. No row of a box can score more with a query than the
sum, over the components, of the larger product of the query's with one of the box's two
ends. A query opens nodes in the order of that bound and stops when the best one left is
below its k-th score; of equal scores all are looked at, as the smaller id wins.

The k-th scores are carried along: from one shard of a task to its next, and from a first
shard, searched before all others, to every task.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import work_path, work_table
from .integer_vectors import (
    BestRows,
    IntegerVectors,
    as_matrix,
    integer_vectors,
    query_blocks,
)

#: Bytes of vectors in a shard, and rows in a leaf.
SHARD_BYTES = 1 << 20
LEAF_ROWS = 128
#: Shards in one file where there are many.
SHARDS_PER_FILE = 128

_TREE = "shard int, ids binary, vectors binary, starts binary, children binary, low binary, high binary"
_FOUND = "query_id long, id long, score long"


class KdTree:
    """Rows in tree order; node ``n`` covers ``starts[n, 0]`` to ``starts[n, 1]``.

    ``children[n]`` are two nodes, or -1 twice in a leaf; ``low`` and ``high`` are the ends
    of its box. Node 0 is the root.
    """

    def __init__(self, ids, vectors, starts, children, low, high):
        self.ids, self.vectors, self.starts, self.children = ids, vectors, starts, children
        self.low, self.high = low, high

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> "KdTree":
        order = np.arange(len(ids))
        starts, children, low, high = [(0, len(ids))], [(-1, -1)], [], []
        node = 0
        while node < len(starts):
            first, end = starts[node]
            rows = order[first:end]
            part = vectors[rows]
            low.append(part.min(axis=0))
            high.append(part.max(axis=0))
            spread = high[-1] - low[-1]
            # Equal rows cannot be told apart; they are one leaf only if it is small.
            if end - first > leaf_rows:
                widest = int(spread.argmax()) if len(spread) else None
                middle = (end - first) // 2
                if widest is not None:
                    rows = rows[np.argpartition(part[:, widest], middle)]
                order[first:end] = rows
                children[node] = (len(starts), len(starts) + 1)
                starts += [(first, first + middle), (first + middle, end)]
                children += [(-1, -1), (-1, -1)]
            node += 1
        return cls(
            ids[order],
            vectors[order],
            np.array(starts, np.int64),
            np.array(children, np.int64),
            np.array(low, vectors.dtype),
            np.array(high, vectors.dtype),
        )

    def search(self, ids: np.ndarray, queries: np.ndarray, best: BestRows) -> int:
        """Improve ``best`` (a group per query) by the rows here; the leaves looked at.

        All queries go on in step: each opens its best node, and those that open the same
        node are one product of matrices.
        """
        above, below = np.maximum(queries, 0), np.minimum(queries, 0)

        def bound(rows, node):
            return above[rows] @ self.high[node] + below[rows] @ self.low[node]

        opened = np.full((len(queries), len(self.starts)), -np.inf)
        everyone = np.arange(len(queries))
        opened[:, 0] = bound(everyone, 0)
        active, visits = everyone, 0
        while len(active):
            pick = opened[active].argmax(axis=1)
            value = opened[active, pick]
            going = (value >= best.border[active]) & (value > -np.inf)
            active, pick = active[going], pick[going]
            opened[active, pick] = -np.inf
            order = np.argsort(pick, kind="stable")
            nodes, first = np.unique(pick[order], return_index=True)
            found = []
            for node, rows in zip(nodes, np.split(active[order], first[1:])):
                left, right = self.children[node]
                if left >= 0:
                    opened[rows, left] = bound(rows, left)
                    opened[rows, right] = bound(rows, right)
                    continue
                visits += len(rows)
                begin, end = self.starts[node]
                scores = queries[rows] @ self.vectors[begin:end].T
                names = self.ids[begin:end]
                good = (scores >= best.border[rows][:, None]) & (names != ids[rows][:, None])
                at, column = np.nonzero(good)
                found.append((rows[at], scores[at, column], names[column]))
            if found:
                best.add(*(np.concatenate(parts) for parts in zip(*found)))
        return visits


def build_trees(vectors: IntegerVectors) -> DataFrame:
    """One row per shard: its KD-tree as byte strings."""
    dims, dtype = vectors.dims, vectors.dtype
    per_shard = max(LEAF_ROWS, SHARD_BYTES // (np.dtype(dtype).itemsize * max(1, dims)))
    n_shards = max(1, -(-vectors.n_rows // per_shard))
    cores = vectors.rows.sparkSession.sparkContext.defaultParallelism
    n_files = max(min(n_shards, 2 * cores), n_shards // SHARDS_PER_FILE)
    shard = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_shards)).cast("int")
    schema = pa.schema(
        [("shard", pa.int32()), *((name.split()[0], pa.binary()) for name in _TREE.split(", ")[1:])]
    )

    def build(table: pa.Table) -> pa.Table:
        matrix = as_matrix(table.column("vector"), dims, dtype)
        tree = KdTree.build(table.column("id").to_numpy(), matrix)
        parts = (tree.ids, tree.vectors, tree.starts, tree.children, tree.low, tree.high)
        columns = [[table.column("shard")[0].as_py()], *([part.tobytes()] for part in parts)]
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )

    dealt = vectors.rows.select(shard.alias("shard"), "id", "vector").repartition(n_files, "shard")
    return work_table(dealt.groupBy("shard").applyInArrow(build, _TREE))


def _search_block(
    trees: DataFrame, vectors: IntegerVectors, ids: np.ndarray, queries: np.ndarray, k: int, known
) -> DataFrame:
    """``query_id, id, score``: at most ``k`` rows per query and task."""
    shared = trees.sparkSession.sparkContext.broadcast((ids, queries, known))
    dims, dtype = vectors.dims, vectors.dtype
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix, reached = shared.value
        best = BestRows(len(names), k, reached)
        for batch in batches:
            for row in range(batch.num_rows):
                part = lambda at, kind: np.frombuffer(
                    batch.column(at)[row].as_buffer(), kind
                )
                tree = KdTree(
                    part(1, np.int64),
                    part(2, dtype).reshape(-1, dims),
                    part(3, np.int64).reshape(-1, 2),
                    part(4, np.int64).reshape(-1, 2),
                    part(5, dtype).reshape(-1, dims),
                    part(6, dtype).reshape(-1, dims),
                )
                tree.search(names, matrix, best)
        group, score, found = best.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[group]), pa.array(found), pa.array(score)], schema=schema
        )

    return trees.mapInArrow(search, _FOUND)


def top_k(
    df: DataFrame,
    queries: F.Column,
    k: int,
    factor: int = 1,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` rows of the largest inner product.

    ``queries`` is a condition on ``id`` that names the rows that ask; all other rows than the
    query's own answer (all, if fewer than ``k``), equal scores by smaller id. What takes
    part and what becomes of repeated ids and vectors of unequal length is said in
    :func:`integer_vectors`; vectors without a component score 0. An empty table gives
    no rows.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = df.sparkSession
    vectors = integer_vectors(df, factor, id_col, vector_col)
    empty = spark.createDataFrame([], "query_id long, rank int, id long, score long")
    if not vectors.n_rows:
        return empty
    if not vectors.dims:
        # Only empty vectors: one component of 0 stands for them.
        rows = vectors.rows.withColumn("vector", F.array(F.lit(0.0)))
        vectors = IntegerVectors(rows, vectors.n_rows, 1, vectors.kind)
    trees = build_trees(vectors)
    first = trees.agg(F.min("shard")).first()[0]
    path = work_path(spark)
    schema = None
    for block, ids, _, matrix in query_blocks(vectors, vectors.rows.where(queries)):
        start = _search_block(trees.where(F.col("shard") == first), vectors, ids, matrix, k, None)
        schema = start.schema
        start.write.parquet(f"{path}/{block}-first")
        # One number per query of the block: the score that k rows reach already.
        reached = dict(
            spark.read.schema(schema)
            .parquet(f"{path}/{block}-first")
            .groupBy("query_id")
            .agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score"))
            .where(F.col("n") >= k)
            .select("query_id", "score")
            .collect()
        )
        known = np.array([reached.get(int(name), -np.inf) for name in ids], np.float64)
        rest = _search_block(trees.where(F.col("shard") != first), vectors, ids, matrix, k, known)
        rest.write.parquet(f"{path}/{block}-rest")
    if schema is None:
        return empty
    found = spark.read.schema(schema).parquet(f"{path}/*")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
