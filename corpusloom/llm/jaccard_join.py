"""Exact Jaccard join of documents on word shingles, by bounds on count vectors.

1. Documents with equal shingle sets form a class, known by the hash of its set.
2. Two sets that are similar enough share one of the first shingles of each, in an
   order that puts shingles of very many documents last. Classes that share one meet
   in a bucket; rows are dealt by range, so that a large bucket spans several tasks.
3. Tokens are hashed into groups. A class is the point of its group counts, and the
   sum of the coordinate minima of two points bounds their overlap. Pairs that the
   bound admits are verified on the whole sets.
   At the first shingle that two sets share, no more than the rest of each set can be
   shared: rows carry how much of their set is left, and a pair whose rests are too
   short waits for no bucket or was let through in an earlier one.
4. A first round verifies neighbours in each bucket, which joins large groups of near
   copies with few pairs. A second round searches an R-tree of the points of each
   bucket, of which only the best pair between two components is verified. Buckets
   that had more are searched a third time, for all pairs between components that are
   still apart, so that no link is lost and no group of copies is expanded into pairs.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import broadcast_if_bounded
from .common import (
    LOWER_ASCII,
    flat_ranges,
    mix64,
    span_hashes,
    text_blocks,
    window_hashes,
    word_spans,
    work_table,
)
from .components import connected_components

SHINGLE_WORDS = 5
#: Similarity in percent: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Groups of the count vectors. The bound tells unrelated sets of up to about twelve
#: times as many shingles apart; counts are single bytes, of which ``MANY`` is open.
GROUPS = 512
MANY = 255
LEAF = 32
FANOUT = 8
#: A shingle is common if it stands in at least this share of the sampled documents.
#: Common shingles come last in the order; that decides which rows meet, not which link.
COMMON_SHARE = 0.0002
COMMON_LEAST = 4
COMMON_SAMPLE = 8

#: Members of a bucket's largest component, and others of its members, in one task.
BUCKET_ROWS = 4096
#: Rows of a run of sizes that are compared by their rests; longer runs stay whole.
RUN_ROWS = 5
#: Bits of a row's place among sizes that hold the rest of its set.
REST_BITS = 31
_WIDE = 1 << 31

_NO_ID = 2**63 - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE_WORDS):
    """Distinct shingle hashes of each text, ascending within it, and where each begins.

    A text of fewer than ``width`` words has its whole sequence as its only shingle,
    one without words has none.
    """
    data = LOWER_ASCII[data]
    starts, ends, first = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    n = np.diff(first)
    counts = np.maximum(n - width + 1, 0)
    hashes = window_hashes(words, width)[flat_ranges(first[:-1], counts)]
    texts = np.repeat(np.arange(len(n)), counts)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        whole = [
            window_hashes(words[first[t] : first[t + 1]], int(n[t]))[0] ^ np.uint64(n[t])
            for t in short
        ]
        hashes = np.concatenate((hashes, np.array(whole, np.uint64)))
        texts = np.concatenate((texts, short))
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    hashes, texts = hashes[new], texts[new]
    return hashes, np.searchsorted(texts, np.arange(len(n) + 1))


def set_hashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set, without regard to order."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(hashes), dtype=np.uint64)))
    return mix64(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))


def count_vectors(hashes: np.ndarray, first: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Row per set: how many of its shingles fall into each group."""
    sets = len(first) - 1
    owner = np.repeat(np.arange(sets), np.diff(first))
    cell = owner * groups + (mix64(hashes ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(groups)).astype(
        np.int64
    )
    counts = np.bincount(cell, minlength=sets * groups).reshape(sets, groups)
    return np.minimum(counts, MANY).astype(np.uint8)


def overlap_bounds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of the coordinate minima of rows; without limit where both counts are open."""
    least = np.minimum(a, b)
    bound = least.sum(axis=1, dtype=np.int64)
    bound[least.max(axis=1, initial=0) == MANY] = 2**40
    return bound


def prefix_lengths(sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """How many first shingles of a set hold one of any similar enough set."""
    return np.where(sizes > 0, sizes + (-sizes * percent // 100) + 1, 0)


def may_link(overlap, size_a, size_b, percent: int = PERCENT):
    """Whether sets of these sizes with this overlap (or bound of it) link."""
    return 100 * overlap >= percent * (size_a + size_b - overlap)


class CountTree:
    """A packed R-tree over count vectors.

    Points are ordered by size and packed into leaves; nodes keep the coordinate
    maxima and the smallest size of what is below them.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((points.argmax(axis=1), sizes))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = [(self.points, self.sizes)]
        width = LEAF
        while len(self.levels[-1][1]) > 1:
            top, least = self.levels[-1]
            cuts = np.arange(0, len(least), width)
            self.levels.append(
                (np.maximum.reduceat(top, cuts, axis=0), np.minimum.reduceat(least, cuts))
            )
            width = FANOUT

    def _admitted(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        top, least = self.levels[level]
        keep = np.zeros(len(a), dtype=bool)
        for at in range(0, len(a), 1 << 12):
            part = slice(at, at + (1 << 12))
            bound = overlap_bounds(top[a[part]], top[b[part]])
            # A smaller size admits more: the smallest below a node stands for all.
            keep[part] = may_link(bound, least[a[part]], least[b[part]], percent)
        return keep

    def pairs(self, labels: np.ndarray, percent: int = PERCENT, meet=None) -> Iterator[tuple]:
        """Places of points with different labels whose bound admits a link.

        ``meet(a, b)`` tells which places are compared at all. Goes down the tree from pairs of nodes to pairs of points, depth first, so
        that few pairs wait at a time.
        """
        labels = labels[self.order]
        root = len(self.levels) - 1
        waiting = [(root, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while waiting:
            level, a, b = waiting.pop()
            if level == 0:
                other = (a < b) & (labels[a] != labels[b])
                a, b = a[other], b[other]
                if meet is not None:
                    near = meet(self.order[a], self.order[b])
                    a, b = a[near], b[near]
            keep = self._admitted(level, a, b, percent)
            a, b = a[keep], b[keep]
            if level == 0:
                if len(a):
                    yield self.order[a], self.order[b]
                continue
            width = LEAF if level == 1 else FANOUT
            limit = len(self.levels[level - 1][1])
            for at in range(0, len(a), 256):
                left, right = a[at : at + 256], b[at : at + 256]
                step = np.arange(width)
                low = (left[:, None] * width + step)[:, :, None]
                high = (right[:, None] * width + step)[:, None, :]
                low, high = np.broadcast_arrays(low, high)
                low, high = low.reshape(-1), high.reshape(-1)
                real = (low < limit) & (high < limit) & (low <= high)
                waiting.append((level - 1, low[real], high[real]))


# The distributed steps.


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in text_blocks(batch, "text"):
            hashes, first = shingle_sets(data, offsets)
            sizes = np.diff(first)
            vectors = count_vectors(hashes, first)
            yield _batch(
                ["doc", "class", "n", "counts"],
                batch.column("doc").slice(row, len(sizes)),
                pa.array(set_hashes(hashes, first).astype(np.int64), mask=sizes == 0),
                sizes.astype(np.int64),
                pa.array([vector.tobytes() for vector in vectors], pa.binary()),
            )


def _sample_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, offsets in text_blocks(batch, "text"):
            hashes, _ = shingle_sets(data, offsets)
            yield _batch(["shingle"], hashes.astype(np.int64))


def _prefix_rows(common):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = common.value
        for batch in batches:
            for _, data, offsets in text_blocks(batch, "text"):
                hashes, first = shingle_sets(data, offsets)
                classes, sizes = set_hashes(hashes, first), np.diff(first)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                late = np.zeros(len(hashes), dtype=bool)
                if len(last):
                    place = np.minimum(np.searchsorted(last, hashes), len(last) - 1)
                    late = last[place] == hashes
                    hashes = hashes[np.lexsort((late, owner))]
                # Of equal sets in the block one is enough.
                _, one = np.unique(classes, return_index=True)
                one = one[sizes[one] > 0]
                counts = prefix_lengths(sizes[one])
                at = flat_ranges(first[one], counts)
                rest = np.repeat(first[one + 1], counts) - at
                yield _batch(
                    ["key", "size", "class"],
                    hashes[at].astype(np.int64),
                    (np.repeat(sizes[one], counts) << REST_BITS) | rest,
                    np.repeat(classes[one], counts).astype(np.int64),
                )

    return rows


BUCKET_SCHEMA = "key long, n long, rest long, class long, before_n long, before long"


def _meet(rest_a, rest_b, size_a, size_b):
    """Whether sets may link if a shingle is the first that they share.

    ``rest``: the shingles of a set from that one on.
    """
    return may_link(np.minimum(rest_a, rest_b), size_a, size_b)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that may link with another row of their key, and pairs of neighbours.

    Takes rows sorted by key, size (with the rest in the low bits) and class. Rows of
    a key whose sizes follow each other closely enough to link are a run. Of a short
    run those rows stay that meet another; long runs and the outermost runs of a
    batch, which may go on in another, stay whole. Neighbours have no key.
    """
    names = [part.split()[0] for part in BUCKET_SCHEMA.split(", ")]
    held = None  # the last row so far: key, size, class
    for batch in batches:
        key, size, group = (batch.column(k).to_numpy() for k in range(3))
        if held is not None:
            key, size, group = (np.concatenate(([h], x)) for h, x in zip(held, (key, size, group)))
        if not len(key):
            continue
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        key, size, group = key[new], size[new], group[new]
        n, rest = size >> REST_BITS, size & ((1 << REST_BITS) - 1)
        same = (key[1:] == key[:-1]) & (100 * n[:-1] >= PERCENT * n[1:])
        cuts = np.concatenate(([0], np.flatnonzero(~same) + 1, [len(key)]))
        lengths = np.diff(cuts)
        whole = lengths > RUN_ROWS
        whole[[0, -1]] = True
        wanted = np.repeat(whole, lengths)
        run = np.repeat(np.arange(len(lengths)), lengths)
        links = np.zeros(0, np.int64)
        for step in range(1, min(RUN_ROWS, len(key))):
            low = np.flatnonzero(run[:-step] == run[step:])
            high = low + step
            near = _meet(rest[low], rest[high], n[low], n[high])
            wanted[low[near]] = wanted[high[near]] = True
            if step == 1:
                links = high[near]
        # The row held before this batch is out already.
        wanted[0] &= held is None
        held = (key[-1], size[-1], group[-1])
        out = np.flatnonzero(wanted)
        mask = np.arange(len(out) + len(links)) >= len(out)
        none = np.zeros(len(links), np.int64)
        blank = np.zeros(len(out), np.int64)
        yield _batch(
            names,
            pa.array(np.concatenate((key[out], none)), mask=mask),
            np.concatenate((n[out], n[links])),
            pa.array(np.concatenate((rest[out], none)), mask=mask),
            np.concatenate((group[out], group[links])),
            pa.array(np.concatenate((blank, n[links - 1])), mask=~mask),
            pa.array(np.concatenate((blank, group[links - 1])), mask=~mask),
        )


def _points(rows, column: str) -> np.ndarray:
    data = b"".join(rows.column(column).to_pylist())
    return np.frombuffer(data, np.uint8).reshape(-1, GROUPS)


def _admitted_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose count vectors admit a link."""
    for batch in batches:
        bound = overlap_bounds(_points(batch, "counts_a"), _points(batch, "counts_b"))
        sizes = [batch.column(k).to_numpy() for k in ("n_a", "n_b")]
        keep = pa.array(may_link(bound, *sizes))
        yield batch.select(["a", "b"]).filter(keep)


FOUND_SCHEMA = "a long, b long, key long"


def _tree_pairs(best: bool):
    """Search the R-tree of each bucket; rows are sorted by key and salt.

    Members of one side are not compared, but those of side -1 are. With ``best``, of
    the pairs between two labels that are found together the one with the highest
    bound comes out, and a row with the key alone tells that there were more. A bucket
    of up to ``LEAF`` members is a single leaf; those of a batch are searched together.
    """

    def columns(rows):
        names = ("key", "class", "label", "n", "rest", "side")
        return _points(rows, "counts"), *(rows.column(k).to_numpy() for k in names)

    def found(key, group, label, sizes, points, a, b) -> Iterator[pa.RecordBatch]:
        if not len(a):
            return
        if best:
            bound = np.concatenate(
                [
                    overlap_bounds(points[a[k : k + 4096]], points[b[k : k + 4096]])
                    for k in range(0, len(a), 4096)
                ]
            )
            score = bound / (sizes[a] + sizes[b])
            low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
            order = np.lexsort((group[b], group[a], -score, high, low, key[a]))
            a, b, low, high = a[order], b[order], low[order], high[order]
            first = np.ones(len(a), dtype=bool)
            first[1:] = (key[a[1:]] != key[a[:-1]]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            more = np.unique(key[a[~first]])
            a, b = a[first], b[first]
            none = pa.nulls(len(more), pa.int64())
            yield _batch(["a", "b", "key"], none, none, more)
        a, b = group[a], group[b]
        none = pa.nulls(len(a), pa.int64())
        yield _batch(["a", "b", "key"], np.minimum(a, b), np.maximum(a, b), none)

    def meeting(sizes, rest, side):
        def meet(a, b):
            apart = (side[a] < 0) | (side[a] != side[b])
            return apart & _meet(rest[a], rest[b], sizes[a], sizes[b])

        return meet

    def search(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        points, key, group, label, sizes, rest, side = columns(rows)
        for a, b in CountTree(points, sizes).pairs(label, meet=meeting(sizes, rest, side)):
            yield from found(key, group, label, sizes, points, a, b)

    def search_leaves(rows: pa.RecordBatch, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``ends``: for each row the end of its bucket in the batch, or the row itself."""
        points, key, group, label, sizes, rest, side = columns(rows)
        at = np.arange(len(ends))
        counts = np.maximum(ends - at - 1, 0)
        left, right = np.repeat(at, counts), flat_ranges(at + 1, counts)
        other = label[left] != label[right]
        left, right = left[other], right[other]
        near = meeting(sizes, rest, side)(left, right)
        left, right = left[near], right[near]
        keep = np.zeros(len(left), dtype=bool)
        for first in range(0, len(left), 1 << 12):
            part = slice(first, first + (1 << 12))
            a, b = left[part], right[part]
            keep[part] = may_link(overlap_bounds(points[a], points[b]), sizes[a], sizes[b])
        yield from found(key, group, label, sizes, points, left[keep], right[keep])

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = None
        for batch in batches:
            if not len(batch):
                continue
            key, salt = batch.column("key").to_numpy(), batch.column("salt").to_numpy()
            new = np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1])) + 1
            cuts = np.concatenate(([0], new, [len(key)]))
            sizes = np.diff(cuts)
            # The outermost buckets may go on in other batches.
            whole = np.ones(len(sizes), dtype=bool)
            whole[[0, -1]] = False
            leaves = whole & (sizes <= LEAF)
            yield from search_leaves(batch, np.repeat(np.where(leaves, cuts[1:], 0), sizes))
            for low, high in zip(cuts[:-1][~leaves], cuts[1:][~leaves]):
                if held and at != (key[low], salt[low]):
                    yield from search(pa.Table.from_batches(held))
                    held = []
                at = (key[low], salt[low])
                held.append(batch.slice(low, high - low))
        if held:
            yield from search(pa.Table.from_batches(held))

    return buckets


def _searched(members: DataFrame, roots: DataFrame, classes: DataFrame, best: bool) -> DataFrame:
    """Pairs of members between components that rests and points admit (``FOUND_SCHEMA``).

    A bucket's largest component is dealt to tasks in blocks, and so are its other
    members. Every block of others meets every block of the component, itself, and
    every other block of others.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = members.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        "key", "n", "rest", "class", F.coalesce("root", "class").alias("label")
    )
    tops = (
        members.groupBy("key", "label")
        .agg(F.count(F.lit(1)).alias("size"))
        .groupBy("key")
        .agg(
            F.max(F.struct("size", "label")).alias("top"),
            F.sum("size").alias("total"),
            F.count(F.lit(1)).alias("labels"),
        )
        .where("labels > 1")
        .select(
            "key",
            F.col("top.label").alias("top"),
            F.ceil(F.col("top.size") / BUCKET_ROWS).alias("tops"),
            F.ceil((F.col("total") - F.col("top.size")) / BUCKET_ROWS).alias("others"),
        )
    )
    place = lambda column: F.pmod(F.xxhash64("class"), F.col(column))
    task = lambda i, j, side: F.struct(
        (i * F.lit(_WIDE) + j).alias("salt"), side.cast("int").alias("side")
    )
    in_top = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("others") - 1),
        lambda j: task(place("tops"), j, F.when(place("tops") == 0, -1).otherwise(0)),
    )
    with_top = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("tops") - 1),
        lambda i: task(i, place("others"), F.when(i == 0, -1).otherwise(1)),
    )
    own = place("others")
    with_others = F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("others") - 1), lambda k: k != own),
        lambda k: task(
            F.col("tops") + F.least(own, k), F.greatest(own, k), F.when(own < k, 0).otherwise(1)
        ),
    )
    tasks = F.when(F.col("label") == F.col("top"), in_top).otherwise(F.concat(with_top, with_others))
    return (
        members.join(tops, "key")
        .select("key", "n", "rest", "class", "label", F.inline(tasks))
        .join(classes.select("class", "counts"), "class")
        .select("key", "salt", "side", "n", "rest", "class", "label", "counts")
        .repartition(parts, "key", "salt")
        .sortWithinPartitions("key", "salt")
        .mapInArrow(_tree_pairs(best), FOUND_SCHEMA)
    )


def _verified(texts: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs of classes whose whole sets link; ``pairs`` is a work table."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    wanted = work_table(classes.select("class", "doc").join(ids, "class"))
    small, _ = broadcast_if_bounded(wanted)
    chosen = texts.join(small, "doc")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(3)
        for batch in batches:
            for row, data, offsets in text_blocks(batch, "text"):
                # Texts given under one id are told apart by their sets.
                own = set_hashes(*shingle_sets(data, offsets)).astype(np.int64)
                expected = batch.column("class").slice(row, len(own)).to_numpy()
                found = np.flatnonzero(own == expected)
                raw = data.tobytes()
                packed = [packer.compress(raw[offsets[k] : offsets[k + 1]]) for k in found]
                yield _batch(["class", "packed"], own[found], pa.array(packed, pa.binary()))

    packed = chosen.mapInArrow(pack, "class long, packed binary")
    one = packed.groupBy("class").agg(F.first("packed").alias("packed"))
    left = one.select(F.col("class").alias("a"), F.col("packed").alias("left"))
    right = one.select(F.col("class").alias("b"), F.col("packed").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            kept = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                texts = [unpacker.decompress(text.as_py()) for text in (left, right)]
                offsets = np.array([0, len(texts[0]), len(texts[0]) + len(texts[1])])
                data = np.frombuffer(b"".join(texts), np.uint8)
                hashes, first = shingle_sets(data, offsets)
                ordered = np.sort(hashes)
                overlap = int((ordered[1:] == ordered[:-1]).sum())
                kept.append(bool(may_link(overlap, *np.diff(first))))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return both.mapInArrow(verify, "a long, b long")


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` of every row.

    Two documents link if 100 * intersection >= 75 * union of their shingle sets; the
    component is named by the smallest id in it. Documents without words (null,
    empty or white space) link with nothing, and their component is their own id. A
    null id never names a component unless all its ids are null; then that is null.
    Repeated rows are copies. Sets are compared by 64-bit hashes of shingles and sets.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc"),
        F.col(text_col).alias("text"),
    )
    known = work_table(
        texts.mapInArrow(_documents, "doc long, class long, n long, counts binary")
    )
    classes = work_table(
        known.where("class is not null")
        .groupBy("class")
        .agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("counts").alias("counts"))
    )
    sample = texts.where(F.pmod(F.xxhash64("doc"), F.lit(COMMON_SAMPLE)) == 0)
    least = max(COMMON_LEAST, int(sample.count() * COMMON_SHARE))
    # At most the mean size of a set / COMMON_SHARE of them, whatever the corpus size.
    frequent = (
        sample.mapInArrow(_sample_shingles, "shingle long")
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least)
    )
    common = np.array([row["shingle"] for row in frequent.select("shingle").toLocalIterator()])
    common = np.sort(common.astype(np.int64).view(np.uint64))
    shipped = spark.sparkContext.broadcast(common)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.mapInArrow(_prefix_rows(shipped), "key long, size long, class long")
    buckets = work_table(
        rows.repartitionByRange(parts, "key", "size", "class")
        .sortWithinPartitions("key", "size", "class")
        .mapInArrow(_buckets, BUCKET_SCHEMA)
    )

    # First round: neighbours in the order of sizes.
    neighbours = (
        buckets.where("before is not null")
        .select(F.least("before", "class").alias("a"), F.greatest("before", "class").alias("b"))
        .distinct()
    )
    point = lambda side: classes.select(
        F.col("class").alias(side),
        F.col("n").alias(f"n_{side}"),
        F.col("counts").alias(f"counts_{side}"),
    )
    with_points = neighbours.join(point("a"), "a").join(point("b"), "b")
    admitted = work_table(
        with_points.select("a", "b", "n_a", "n_b", "counts_a", "counts_b").mapInArrow(
            _admitted_pairs, "a long, b long"
        )
    )
    links = work_table(_verified(texts, classes, admitted))
    roots = work_table(connected_components(links))

    # Second round: of the pairs between two components the best of each bucket.
    members = buckets.where("before is null").select("key", "n", "rest", "class")
    found = work_table(_searched(members, roots, classes, best=True))
    pairs = found.where("a is not null").select("a", "b").distinct()
    tried = work_table(pairs.join(admitted, ["a", "b"], "left_anti"))
    more = work_table(_verified(texts, classes, tried))
    if more.take(1):
        links = links.union(more)
        roots = work_table(connected_components(links))

    # Third round: all pairs that are left between components.
    open_keys = work_table(found.where("a is null").select("key").distinct())
    if open_keys.take(1):
        members = members.join(open_keys, "key", "left_semi")
        pairs = _searched(members, roots, classes, best=False).select("a", "b").distinct()
        done = admitted.union(tried)
        left = work_table(pairs.join(done, ["a", "b"], "left_anti"))
        more = work_table(_verified(texts, classes, left))
        if more.take(1):
            roots = connected_components(links.union(more))

    named = (
        classes.select("class", "doc")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .select("class", "doc", F.coalesce("root", "class").alias("root"))
    )
    smallest = named.groupBy("root").agg(F.min("doc").alias("component"))
    of_class = named.join(smallest, "root").select("class", "component")
    own_id = lambda column: F.when(F.col(column) != _NO_ID, F.col(column)).cast(kind)
    return known.join(of_class, "class", "left").select(
        own_id("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce(own_id("component"), own_id("doc")).alias("component_id"),
    )
