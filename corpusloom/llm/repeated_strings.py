"""Removal of repeated byte strings of a whole corpus by suffix arrays.

Every byte covered by a ``length``-byte string that also starts earlier is removed.

1. Each such string holds an anchor: the place of the smallest hash among its grams.
   Equal strings have equal anchors, so only anchors that occur again matter. The
   strings of one anchor are successive and form a context of a few dozen to 167 bytes.
2. A context that occurs again byte for byte is marked without looking further.
3. Different contexts of one anchor gram are dealt to tasks by the gram, where a
   suffix array (two-stage sorting) and its adjacent common prefixes find the strings
   they share. Contexts of a gram that very many documents hold are dealt to several
   tasks; one row per different string then meets by its hash.
4. The marked spans of each document are cut out.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (
    byte_values,
    flat_ranges,
    mix64,
    text_blocks,
    window_hashes,
    work_table,
)

LENGTH = 100
GRAM = 32
#: A gram is hot if it stands in at least this share of the sampled documents.
HOT_SHARE = 0.01
HOT_LEAST = 8
#: One document of so many, by a hash of its id, tells which grams are hot. This only
#: decides how rows are dealt to tasks.
HOT_SAMPLE = 64
HOT_SALTS = 64
#: Bytes of contexts in one suffix array; the contexts of one key stay together.
ARRAY_BYTES = 1 << 20

_NULL_ID = -(2**63)
_START_BITS = 7  # strings per anchor, below 2**7
_BASE = 0xD6E8FEB86659FD93
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept by the worker."""
    if len(_POWERS[0]) < size:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            powers = np.full(size, base, dtype=np.uint64)
            powers[0] = 1
            _POWERS[k] = np.cumprod(powers, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    covered = 1
    while 2 * covered <= width:
        values = np.minimum(values[:-covered], values[covered:])
        covered *= 2
    rest = width - covered
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Anchors of all ``length``-byte strings inside the texts of a block.

    Returns arrays, one entry per anchor: text number, start of its first string in
    the text, number of its strings, hash of its gram, hash of its context.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    grams = window_hashes(byte_values(data), gram)
    places = np.arange(len(grams), dtype=np.uint64)
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | places
    lowest = _sliding_minimum(ranked, length - gram + 1)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    starts = flat_ranges(offsets[:-1], counts)
    if not len(starts):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    anchor = (lowest[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    texts = np.repeat(np.arange(len(counts)), counts)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (texts[1:] != texts[:-1])
    first = np.flatnonzero(new)
    low, place, text = starts[first], anchor[first], texts[first]
    n = np.diff(np.append(first, len(starts)))
    powers, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values(data) * powers[: len(data)], out=sums[1:])
    context = (sums[low + n + length - 1] - sums[low]) * inverse[low]
    shape = ((place - low) << 8 | n).astype(np.uint64)
    context = mix64(context + mix64(shape))
    return text, low - offsets[text], n, grams[place], context


ANCHOR_SCHEMA = "gram long, context long, doc long, span long, repeated boolean"


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc").to_numpy(zero_copy_only=False)
        for row, data, offsets in text_blocks(batch, "text"):
            text, low, n, gram, context = anchors(data, offsets)
            doc = ids[row + text]
            span = low << _START_BITS | n
            order = np.lexsort((span, doc, context, gram))
            gram, context, doc, span = (x[order] for x in (gram, context, doc, span))
            again = np.zeros(len(gram), dtype=bool)
            again[1:] = (gram[1:] == gram[:-1]) & (context[1:] == context[:-1])
            # A text given twice under one id does not repeat itself.
            again[1:] &= (doc[1:] != doc[:-1]) | (span[1:] != span[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(gram.astype(np.int64)),
                    pa.array(context.astype(np.int64)),
                    pa.array(doc),
                    pa.array(span),
                    pa.array(again),
                ],
                names=["gram", "context", "doc", "span", "repeated"],
            )


# Two-stage suffix sorting.


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number; zeros after the end."""
    words = np.zeros(len(data) + 8, np.uint64)
    words[: len(data)] = data
    for shift in (1, 2, 4):
        words[:-shift] = words[:-shift] << np.uint64(8 * shift) | words[shift:]
    return words


def smaller_than_successor(data: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the suffix one byte shorter."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=bool)
    change = np.append(np.flatnonzero(data[1:] != data[:-1]), n - 1)
    rising = np.append(data[change[:-1]] < data[change[:-1] + 1], False)
    return rising[np.searchsorted(change, np.arange(n))]


def _sort_directly(words: np.ndarray, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """Sort suffixes by their first ``depth`` bytes (rounded up to eight)."""
    order = suffixes[np.argsort(words[suffixes], kind="stable")]
    key = words[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    last = len(words) - 1
    for at in range(8, depth, 8):
        # Only suffixes that are still equal to a neighbour are looked at again.
        open_ = ~new
        open_[:-1] |= ~new[1:]
        tied = np.flatnonzero(open_)
        if not len(tied):
            break
        group = np.cumsum(new[tied])
        key = words[np.minimum(order[tied] + at, last)]
        within = np.lexsort((key, group))
        order[tied] = order[tied][within]
        key = key[within]
        fresh = np.ones(len(tied), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        new[tied] |= fresh
    return order


def suffix_array(data: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes of ``data`` in order of their first ``depth`` bytes at least.

    Suffixes smaller than their successors are sorted directly. The others are
    induced: a scan of the buckets of first bytes, in ascending order, puts before
    each suffix found the one that is a byte longer.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    small = smaller_than_successor(data)
    direct = np.flatnonzero(small)
    if len(direct):
        direct = _sort_directly(_words(data), direct, depth + 8)
    bounds = np.searchsorted(data[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[data[n - 1]].append(np.array([n - 1]))
    out = []
    for byte in range(256):
        # Larger suffixes of the bucket: from smaller bytes first, then runs of this one.
        level = np.concatenate(induced[byte]) if induced[byte] else np.zeros(0, np.int64)
        bucket = []
        while len(level):
            bucket.append(level)
            before = level[level > 0] - 1
            level = before[data[before] == byte]
        bucket.append(direct[bounds[byte] : bounds[byte + 1]])
        found = np.concatenate(bucket)
        if not len(found):
            continue
        out.append(found)
        before = found[found > 0] - 1
        heads = data[before]
        before, heads = before[heads > byte], heads[heads > byte]
        by_head = np.argsort(heads, kind="stable")
        before, heads = before[by_head], heads[by_head]
        cuts = np.flatnonzero(np.diff(heads)) + 1
        for part in np.split(before, cuts) if len(before) else ():
            induced[data[part[0]]].append(part)
    return np.concatenate(out)


def common_prefixes(data: np.ndarray, order: np.ndarray, limit: int = LENGTH) -> np.ndarray:
    """Length up to ``limit`` of what each suffix of ``order`` shares with the one before."""
    words = _words(data)
    last = len(words) - 1
    shared = np.zeros(len(order), dtype=np.int64)
    rows = np.arange(1, len(order))
    for at in range(0, limit, 8):
        left = words[np.minimum(order[rows - 1] + at, last)]
        right = words[np.minimum(order[rows] + at, last)]
        same = left == right
        # The first byte that differs is the highest one of the exclusive or.
        unequal = rows[~same]
        diff = left[~same] ^ right[~same]
        bits = np.frexp(diff.astype(np.float64))[1]
        high = np.uint64(1) << np.minimum(bits, 63).astype(np.uint64)
        bits -= (diff < high >> np.uint64(1)) & (bits < 64)
        shared[unequal] = at + (64 - bits) // 8
        rows = rows[same]
        if not len(rows):
            break
    shared[rows] = limit
    return np.minimum(shared, limit)


def shared_strings(contexts: list[bytes], docs: np.ndarray, lows: np.ndarray, length: int):
    """The strings of some contexts, grouped by content.

    Yields arrays of one entry per string, ordered by content, then document and
    start: context number, start in the context, and whether it is its group's first.
    """
    sizes = np.array([len(context) for context in contexts])
    data = np.frombuffer(b"".join(contexts), np.uint8)
    firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    order = suffix_array(data, length)
    owner = np.searchsorted(firsts, order, side="right") - 1
    start = order - firsts[owner]
    real = start + length <= sizes[owner]
    order, owner, start = order[real], owner[real], start[real]
    group = np.cumsum(common_prefixes(data, order, length) < length)
    place = lows[owner] + start
    by_group = np.lexsort((place, docs[owner], group))
    group, owner, start = group[by_group], owner[by_group], start[by_group]
    first = np.ones(len(group), dtype=bool)
    first[1:] = group[1:] != group[:-1]
    # A string met twice at one place (a text given twice) is the first each time.
    return order[by_group], owner, start, first, group


SPAN_SCHEMA = "doc long, low long, high long, string_a long, string_b long"


def _spans_of_contexts(length: int):
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, key = 0, None
        for batch in batches:
            columns = [batch.column(n) for n in ("gram", "salt", "doc", "span", "bytes")]
            for gram, salt, doc, span, data in zip(*[c.to_pylist() for c in columns]):
                if size >= ARRAY_BYTES and key != (gram, salt):
                    yield _span_batch(held, length)
                    held, size = [], 0
                key = (gram, salt)
                held.append((salt, doc, span >> _START_BITS, data))
                size += len(data)
        if held:
            yield _span_batch(held, length)

    return spans


def _span_batch(held: list[tuple], length: int) -> pa.RecordBatch:
    salts, docs, lows = (np.array([row[k] for row in held], np.int64) for k in range(3))
    contexts = [row[3] for row in held]
    order, owner, start, first, group = shared_strings(contexts, docs, lows, length)
    place = lows[owner] + start
    # Entries of one group are in order of place, so its first stands before them.
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    later = (docs[owner] != docs[owner[head]]) | (place != place[head])
    marked = np.flatnonzero(later)
    # Strings marked one after the other in a context are one span.
    by_place = np.lexsort((start[marked], owner[marked]))
    own, at = owner[marked][by_place], start[marked][by_place]
    new = np.ones(len(own), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(own)) - 1 if len(own) else begin
    low, high = lows[own[begin]] + at[begin], lows[own[end]] + at[end] + length
    doc = docs[own[begin]]
    # Of a gram dealt to several tasks, one row per string goes on to meet the others.
    on = np.flatnonzero(first & (salts[owner] >= 0))
    data = np.frombuffer(b"".join(contexts), np.uint8)
    a, b = _string_hashes(data, order[on], length)
    none = np.zeros(len(doc), np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((doc, docs[owner[on]]))),
            pa.array(np.concatenate((low, place[on]))),
            pa.array(np.concatenate((high, place[on] + length))),
            pa.array(np.concatenate((none, a)), mask=np.arange(len(none) + len(a)) < len(none)),
            pa.array(np.concatenate((none, b)), mask=np.arange(len(none) + len(b)) < len(none)),
        ],
        names=["doc", "low", "high", "string_a", "string_b"],
    )


def _string_hashes(data: np.ndarray, places: np.ndarray, length: int):
    """Two independent 64-bit hashes of the strings at some places."""
    if not len(places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    one = window_hashes(byte_values(data), length)[places]
    two = window_hashes(mix64(byte_values(data)), length)[places]
    return one.astype(np.int64), two.astype(np.int64)


# The distributed steps.


def _packed(texts: DataFrame) -> DataFrame:
    """Texts compressed, for the shuffles that bring them to their spans."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(3)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            packed = [packer.compress(text.as_buffer() if text.is_valid else b"") for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("doc"), pa.array(packed, pa.binary())],
                names=["id", "doc", "packed"],
            )

    kind = dict(texts.dtypes)["id"]
    return texts.mapInArrow(pack, f"id {kind}, doc long, packed binary")


def _contexts(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted contexts."""
    grouped = wanted.groupBy("doc").agg(
        F.collect_list("gram").alias("grams"),
        F.collect_list("salt").alias("salts"),
        F.collect_list("span").alias("spans"),
    )
    joined = _packed(texts).join(grouped, "doc").select("doc", "packed", "grams", "salts", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        names = ["gram", "salt", "doc", "span", "bytes"]
        for batch in batches:
            rows, size = [], 0
            for doc, packed, grams, salts, spans in zip(
                *[batch.column(k).to_pylist() for k in range(5)]
            ):
                data = unpacker.decompress(packed)
                for gram, salt, span in zip(grams, salts, spans):
                    low, n = span >> _START_BITS, span & ((1 << _START_BITS) - 1)
                    found = data[low : low + n + length - 1]
                    rows.append((gram, salt, doc, span, found))
                    size += len(found)
                if size > 2 << 20:
                    arrays = [pa.array(values) for values in zip(*rows)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
                    rows, size = [], 0
            if rows:
                arrays = [pa.array(values) for values in zip(*rows)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return joined.mapInArrow(cut, "gram long, salt long, doc long, span long, bytes binary")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc``, ``low``, ``high``: spans of bytes covered by strings that start earlier.

    ``docs`` has ``doc`` (long, not null) and ``text``. Spans of one document may
    overlap.
    """
    spark = docs.sparkSession
    texts = docs.select("doc", "text")
    # Grams that very many documents hold, from a sample; at most 1 / HOT_SHARE times
    # the anchors of a document, however large the corpus is.
    sample = texts.where(F.pmod(F.xxhash64("doc"), F.lit(HOT_SAMPLE)) == 0)
    sampled = sample.mapInArrow(_anchor_rows, ANCHOR_SCHEMA).select("gram", "doc").distinct()
    least = max(HOT_LEAST, int(sample.count() * HOT_SHARE))
    hot = work_table(
        sampled.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    ).select("gram", F.lit(True).alias("hot"))
    rows = texts.mapInArrow(_anchor_rows, ANCHOR_SCHEMA).join(F.broadcast(hot), "gram", "left")
    # A context of a hot gram is dealt by its own hash, any other by its gram.
    salt = F.when(F.col("hot"), F.pmod("context", F.lit(HOT_SALTS))).otherwise(-1)
    # A context repeated inside its block is known to be so and meets nothing.
    dealt = F.when(F.col("repeated"), F.xxhash64("doc", "span")).otherwise(F.col("gram"))
    rows = rows.select(
        dealt.alias("dealt"), "gram", "context", "doc", "span", "repeated", salt.alias("salt")
    )
    by_gram = Window.partitionBy("dealt", "salt", "repeated")
    by_context = Window.partitionBy("dealt", "salt", "repeated", "context").orderBy("doc", "span")
    # One exchange serves both windows.
    rows = rows.repartition("dealt", "salt", "repeated")
    ranked = rows.withColumn("place", F.rank().over(by_context)).withColumn(
        "contexts", F.count(F.when(F.col("place") == 1, 1)).over(by_gram)
    )
    again = F.col("repeated") | (F.col("place") > 1)
    open_ = ~again & ((F.col("contexts") > 1) | (F.col("salt") >= 0))
    found = work_table(
        ranked.where(again | open_).select("gram", "salt", "doc", "span", again.alias("again"))
    )
    start = F.shiftright("span", _START_BITS)
    strings = F.col("span").bitwiseAND((1 << _START_BITS) - 1)
    whole = found.where("again").select(
        "doc", start.alias("low"), (start + strings + length - 1).alias("high")
    )
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    contexts = (
        _contexts(texts.withColumn("id", F.lit(0)), found.where("not again"), length)
        .repartition(int(parts), "gram", "salt")
        .sortWithinPartitions("gram", "salt")
    )
    spans = work_table(contexts.mapInArrow(_spans_of_contexts(length), SPAN_SCHEMA))
    by_string = Window.partitionBy("string_a", "string_b").orderBy("doc", "low")
    met = (
        spans.where("string_a is not null")
        .withColumn("place", F.rank().over(by_string))
        .where("place > 1")
    )
    sure = spans.where("string_a is null")
    columns = ("doc", "low", "high")
    return whole.union(sure.select(*columns)).union(met.select(*columns))


def cut_spans(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of ``data``, bytes removed, and maximal runs removed."""
    kept, at, removed, runs, last = [], 0, 0, 0, None
    for low, high in sorted(spans):
        high = min(high, len(data))
        if low >= high:
            continue
        if last is None or low > last:
            kept.append(data[at:low])
            runs += 1
            last = low
            at = low
        if high > last:
            removed += high - last
            last = at = high
    kept.append(data[at:])
    return b"".join(kept), removed, runs


RESULT_SCHEMA = "n_bytes long, n_removed long, n_spans long, kept binary"


def remove_repeated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` of every row.

    Earlier means a smaller id, or the same id and an earlier start. A null text is
    empty. A null id comes before all others. Rows with equal ids do not repeat each
    other; each is cut by the spans found in any of them. ``kept`` are the bytes left,
    which need not be valid UTF-8.
    """
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc"),
        F.col(text_col).alias("text"),
    )
    spans = repeated_spans(texts, length).groupBy("doc")
    spans = spans.agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))
    joined = _packed(texts).join(spans, "doc", "left").select("id", "packed", "lows", "highs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        names = [id_col, "n_bytes", "n_removed", "n_spans", "kept"]
        for batch in batches:
            ids, packed, lows, highs = (batch.column(k) for k in range(4))
            rows, size, first = [], 0, 0
            for row in range(len(batch)):
                data = unpacker.decompress(packed[row].as_py())
                found = list(zip(lows[row].as_py() or (), highs[row].as_py() or ()))
                kept, removed, runs = cut_spans(data, found)
                rows.append((len(data), removed, runs, kept))
                size += len(kept)
                if size > 4 << 20 or row == len(batch) - 1:
                    arrays = [pa.array(values, t) for values, t in zip(zip(*rows), types)]
                    own = ids.slice(first, len(rows))
                    yield pa.RecordBatch.from_arrays([own, *arrays], names=names)
                    rows, size, first = [], 0, row + 1

    return joined.mapInArrow(cut, f"`{id_col}` {kind}, {RESULT_SCHEMA}")
