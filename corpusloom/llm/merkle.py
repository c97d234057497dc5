"""A Merkle manifest of a table, with a witness per row.

Leaves are grouped and ordered; in each group every ``ARITY`` successive nodes of a level
become their parent until one is left. The roots of the groups, in the order of the
groups, are the leaves of one more tree, whose root stands for the table.

Leaves are appended to aligned blocks of ``ARITY ** BLOCK_LEVELS`` leaves, each a whole subtree. While a task appends, each leaf carries a partial witness: the siblings on
its way up to the open subtree it is in. When a later sibling completes a run, the
witnesses below all nodes of the run are extended. The roots of the blocks are appended in turn,
as leaves of the next round, and so on to the root of the group; the witness of a block's
root is the rest of the witness of all its leaves.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..plans import broadcast_if_bounded, salted_join
from .common import work_table

ARITY = 3
#: Levels of a block: 2,187 leaves.
BLOCK_LEVELS = 7

_DIGEST = 32
#: Rows that a task returns at once.
_BATCH_ROWS = 4096


def digest_of(parts: list[bytes]) -> bytes:
    """SHA-256 of the hex text of the digests."""
    return hashlib.sha256(b"".join(part.hex().encode() for part in parts)).digest()


def leaf_digest(columns: list[str | Column]) -> Column:
    """Digest of a row: each value as its byte count, ``:`` and text, a null as ``-``."""
    parts = []
    for name in columns:
        text = (F.col(name) if isinstance(name, str) else name).cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


class Block:
    """Successive appends to one aligned block.

    ``paths[n]`` is the partial witness of leaf ``n``: the siblings so far, and for each
    level its place in the run and the number of siblings.
    """

    def __init__(self, levels: int = BLOCK_LEVELS) -> None:
        self.levels = levels
        self.paths: list[tuple[bytearray, bytearray]] = []
        #: The open run of each level: digests and the leaves below them.
        self.open: list[list[tuple[bytes, list[int]]]] = []

    def append(self, digest: bytes) -> None:
        self.paths.append((bytearray(), bytearray()))
        self._add(0, digest, [len(self.paths) - 1])

    def _add(self, level: int, digest: bytes, leaves: list[int]) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        run.append((digest, leaves))
        # A block is one subtree: its root has no siblings here.
        if len(run) == ARITY and level < self.levels:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [digest for digest, _ in run]
        below: list[int] = []
        for place, (_, leaves) in enumerate(run):
            others = b"".join(digests[:place] + digests[place + 1 :])
            shape = bytes((place, len(run) - 1))
            for leaf in leaves:
                siblings, shapes = self.paths[leaf]
                siblings += others
                shapes += shape
            below += leaves
        self._add(level + 1, digest_of(digests), below)

    def close(self, levels: int) -> bytes:
        """Complete the open runs up to the root, ``levels`` above the leaves."""
        for level in range(levels):
            if level < len(self.open) and self.open[level]:
                self._complete(level)
        ((root, _),) = self.open[levels]
        return root


def levels_of(n: int, most: int) -> int:
    """Levels above ``n`` leaves until one node is left, ``most`` at most."""
    levels, reach = 0, 1
    while reach < n and levels < most:
        levels, reach = levels + 1, reach * ARITY
    return levels


def fold(digest: bytes, siblings: bytes, shapes: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    at = 0
    for level in range(0, len(shapes), 2):
        place, others = shapes[level], shapes[level + 1]
        run = [siblings[at + _DIGEST * n : at + _DIGEST * (n + 1)] for n in range(others)]
        run.insert(place, digest)
        digest = digest_of(run)
        at += _DIGEST * others
    return digest


def group_key(group: str) -> Column:
    """A group's name that is never null and sorts bytewise, the null group first."""
    return F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with ``position`` in their ``group`` and ``n``, its size.

    Rows are sorted by ranges, so a group of any size spans tasks; their counts alone,
    one row per group and task, give the position of each task's first row.
    """
    # Rows that are equal in all have places of their own.
    salted = work_table(leaves.withColumn("salt", F.monotonically_increasing_id()))
    order = ["group", *order, "salt"]
    ordered = (
        salted.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        # In the upper bits the number of the task, in the lower ones that of the row.
        .withColumn("row", F.monotonically_increasing_id())
    )
    ordered = work_table(ordered.withColumn("task", F.shiftright("row", 33)).drop("salt"))
    counts = ordered.groupBy("group", "task").agg(
        F.min("row").alias("first"), F.count(F.lit(1)).alias("rows")
    )
    of_group = Window.partitionBy("group")
    before = F.sum("rows").over(of_group.orderBy("task")) - F.col("rows")
    starts = work_table(
        counts.select(
            "group",
            "task",
            (F.col("first") - before).alias("start"),
            F.sum("rows").over(of_group).alias("n"),
        )
    )
    starts, _ = broadcast_if_bounded(starts)
    return (
        ordered.join(starts, ["group", "task"])
        .withColumn("position", F.col("row") - F.col("start"))
        .drop("row", "task", "start")
    )


def _append(nodes: DataFrame, levels: int) -> DataFrame:
    """One round of appends: ``nodes`` with their witnesses inside their block.

    ``nodes`` has ``group``, ``position``, ``n``, ``leaf`` and columns to keep. New are
    ``block``, ``siblings``, ``shapes`` and ``top``, the root of the block.
    """
    block = F.expr(f"position div {ARITY**levels}").alias("block")
    dealt = nodes.select("group", block, "position", "n", "leaf", *_kept(nodes))
    out = _with_binary(dealt, "siblings", "shapes", "top")
    schema = to_arrow_schema(out)

    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []

        def finish() -> None:
            top = current.close(levels_of(rows[0][3], levels))
            done.extend(
                (*row, bytes(siblings), bytes(shapes), top)
                for row, (siblings, shapes) in zip(rows, current.paths)
            )

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*done), schema)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        rows, current, key = [], Block(levels), None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if rows and row[:2] != key:
                    finish()
                    rows, current = [], Block(levels)
                    if len(done) >= _BATCH_ROWS:
                        yield flushed()
                key = row[:2]
                rows.append(row)
                current.append(row[4])
        if rows:
            finish()
        if done:
            yield flushed()

    return (
        dealt.repartition("group", "block")
        .sortWithinPartitions("group", "block", "position")
        .mapInArrow(append, out)
    )


def _with_binary(df: DataFrame, *names: str) -> T.StructType:
    more = [T.StructField(name, T.BinaryType()) for name in names]
    return T.StructType([*df.schema.fields, *more])


def _kept(nodes: DataFrame) -> list[str]:
    own = ("group", "block", "position", "n", "leaf", "siblings", "shapes", "top")
    return [name for name in nodes.columns if name not in own]


def _tops(appended: DataFrame, size: int) -> DataFrame:
    """The block roots as nodes of the next round."""
    return appended.where(F.col("position") == F.col("block") * size).select(
        "group",
        F.col("block").alias("position"),
        F.expr(f"(n + {size - 1}) div {size}").alias("n"),
        F.col("top").alias("leaf"),
    )


def _extended(lower: DataFrame, upper: DataFrame) -> DataFrame:
    """Witnesses continued by those of their block roots, which the next round appended."""
    rest = upper.select(
        "group",
        F.col("position").alias("block"),
        F.col("siblings").alias("more"),
        F.col("shapes").alias("more_shapes"),
        "root",
    )
    rest, _ = broadcast_if_bounded(rest)
    return _continued(lower.drop("top").join(rest, ["group", "block"]).drop("block", "n"))


def _continued(rows: DataFrame) -> DataFrame:
    """``siblings`` and ``shapes`` followed by ``more`` and ``more_shapes``."""
    return (
        rows.withColumn("siblings", F.concat("siblings", "more"))
        .withColumn("shapes", F.concat("shapes", "more_shapes"))
        .drop("more", "more_shapes")
    )


def _witnesses(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` with their witness up to ``root``, that of their group.

    Each round of appends divides the largest group by the leaves of a block.
    """
    size = ARITY**levels
    largest = nodes.agg(F.max("n")).first()[0] or 0
    rounds = [work_table(_append(nodes, levels))]
    while largest > size:
        largest = -(-largest // size)
        rounds.append(work_table(_append(_tops(rounds[-1], size), levels)))
    # In the last round every group is one block.
    found = rounds.pop().drop("block", "n").withColumnRenamed("top", "root")
    for lower in reversed(rounds):
        found = work_table(_extended(lower, found))
    return found


def merkle_manifest(leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """``leaves`` with ``subroot``, ``root``, ``siblings`` and ``shapes``.

    ``leaves`` has ``group`` (as of :func:`group_key`), ``id`` (integer), ``leaf`` (a digest
    of 32 bytes) and columns to keep, which must have other names than those made here. Groups
    ascend bytewise; in a group, leaves ascend by id, null ids first, equal ids by digest.
    ``siblings`` are the digests of the witness from the leaf to the root, those of a
    run from left to right; ``shapes`` has two bytes per level, the place in the run and
    the number of siblings. A lone leaf is its subroot, a lone subroot the root. Rows that
    are equal in all count each. An empty table gives no rows.
    """
    numbered = work_table(_numbered(leaves, ["id", "leaf"]))
    found = _witnesses(numbered, block_levels).withColumnRenamed("root", "subroot")
    # The groups' roots, in the order of the groups, are one more group of leaves.
    subroots = found.where("position = 0").select(
        F.lit("").alias("group"), F.col("group").alias("of"), F.col("subroot").alias("leaf")
    )
    upper = _witnesses(work_table(_numbered(subroots, ["of"])), block_levels)
    upper = upper.select(
        F.col("of").alias("group"),
        "root",
        F.col("siblings").alias("more"),
        F.col("shapes").alias("more_shapes"),
    )
    small, fits = broadcast_if_bounded(upper)
    if fits:
        both = found.join(small, "group")
    else:
        both = salted_join(found, upper, ["group"], ["position"])
    return _continued(both).drop("position")


def folded_root(manifest: DataFrame, leaf: str, column: str) -> DataFrame:
    """``manifest`` with ``column``: the root that the digest in ``leaf`` leads to."""
    names = [leaf, "siblings", "shapes"]
    at = [manifest.columns.index(name) for name in names]
    out = _with_binary(manifest, column)
    schema = to_arrow_schema(out)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = zip(*(batch.column(n).to_pylist() for n in at))
            roots = pa.array([fold(*value) for value in values], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, roots], schema=schema)

    return manifest.mapInArrow(folded, out)
