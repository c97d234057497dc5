"""Links between fetched pages and the bounded crawl over them."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import absolute_url, decode_references, url_host
from ..plans import cut_lineage, dense_numbers, first_per_key, salted_join
from ..sources.pages import drop_http_errors

_VALUE = r"""href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
ANCHOR = rf"(?is)<a\s(?:[^>]*?\s)?{_VALUE}"
ANCHOR_HREF = rf"(?is)\s{_VALUE}\z"
BASE = rf"(?is)<base\s(?:[^>]*?\s)?{_VALUE}"

#: Seeds from which a crawl keeps bitmaps of seeds per URL instead of pairs. A bitmap has
#: 4 KB before compression, a pair some 100 bytes.
BITMAP_SEEDS = 1_000
#: Seeds per bitmap, as the bitmap functions have it.
_BITMAP_BITS = 32_768
#: Pairs that are returned at once when bitmaps are read.
_PAIRS_PER_BATCH = 1 << 16


def _href(tag: Column) -> Column:
    """Value of the attribute that ends ``tag``, with its character references decoded."""
    value = F.concat(*[F.regexp_extract(tag, ANCHOR_HREF, n) for n in (1, 2, 3)])
    return F.trim(decode_references(value))


def extract_hrefs(pages: DataFrame) -> DataFrame:
    """``src_url, base_url, href`` of every anchor of every HTML page, in the JVM.

    ``base_url`` is what links of the page are resolved against: the href of its first
    base element, itself resolved against the URL, or the URL.
    """
    typed = F.coalesce("content_type", F.lit(""))
    html = pages.where((typed == "") | F.lower(typed).contains("html"))
    base = _href(F.regexp_extract("body", BASE, 0))
    hrefs = F.transform(F.regexp_extract_all("body", F.lit(ANCHOR), F.lit(0)), _href)
    return (
        html.select(F.col("url").alias("src_url"), "body", base.alias("base"))
        .select(
            "src_url",
            F.when(F.col("base") != "", absolute_url("src_url", "base")).alias("base"),
            # An outer explode: for an inner one the hrefs would be made twice.
            F.explode_outer(hrefs).alias("href"),
        )
        .where(F.col("href") != "")
        .select("src_url", F.coalesce("base", "src_url").alias("base_url"), "href")
    )


def extract_links(pages: DataFrame, same_host: bool = True) -> DataFrame:
    """Distinct edges ``src_url, dst_url``; by default only within a host."""
    # A filter on an exploded column stays above what makes it.
    found = F.explode(F.array(absolute_url("base_url", "href"))).alias("dst_url")
    edges = extract_hrefs(pages).select("src_url", found)
    if same_host:
        edges = edges.where(url_host("src_url") == url_host("dst_url"))
    return edges.where(F.col("dst_url").isNotNull()).distinct()


def _visit_key(url: str):
    return F.regexp_replace(url, r"(?s)#.*\z", "")


def crawl_frontier(
    seeds: DataFrame,
    edges: DataFrame,
    max_depth: int,
    follow_links: bool = True,
    bitmap_seeds: int = BITMAP_SEEDS,
) -> DataFrame:
    """``seed_url, url, depth`` of every URL reached from a seed.

    Breadth first: a seed has depth 1 and a URL its least depth; a fragment does
    not make a URL new. ``max_depth`` 0 goes on until nothing new is found, which
    the anti join with what was visited brings about. Links are followed on the
    seed's host only.
    Every round joins the newest URLs with the edges, keeps the unseen ones and
    is cut from its lineage by a checkpoint. From ``bitmap_seeds`` seeds on, a round has one
    row per URL, with a bitmap of the seeds that reach it, instead of one per seed
    and URL; the result is the same.
    """
    frontier = seeds.select(
        F.col("url").alias("seed_url"),
        F.col("url"),
        _visit_key("url").alias("key"),
        F.lit(1).alias("depth"),
    ).distinct()
    if not follow_links or max_depth == 1:
        return frontier.drop("key")
    links = cut_lineage(
        edges.where(url_host("src_url") == url_host("dst_url"))
        .select(
            _visit_key("src_url").alias("key"),
            F.col("dst_url"),
            _visit_key("dst_url").alias("dst_key"),
        )
        .groupBy("key", "dst_key")
        .agg(F.min("dst_url").alias("dst_url"))
    )
    frontier = cut_lineage(frontier)
    many = frontier.count() >= bitmap_seeds
    visited = (_visited_bitmaps if many else _visited_pairs)(frontier, links, max_depth)
    return visited.select("seed_url", "url", "depth")


def _visited_pairs(frontier: DataFrame, links: DataFrame, max_depth: int) -> DataFrame:
    visited = frontier
    depth = 1
    while max_depth == 0 or depth < max_depth:
        depth += 1
        # A page that very many seeds reach is split by seed.
        reached = (
            salted_join(frontier.select("seed_url", "key"), links, ["key"], ["seed_url"])
            .groupBy("seed_url", F.col("dst_key").alias("key"))
            .agg(F.min("dst_url").alias("url"))
        )
        frontier = cut_lineage(
            reached.join(visited.select("seed_url", "key"), ["seed_url", "key"], "left_anti")
            .select("seed_url", "url", "key", F.lit(depth).alias("depth"))
        )
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited


def _visited_bitmaps(frontier: DataFrame, links: DataFrame, max_depth: int) -> DataFrame:
    """The same as pairs, with ``bits`` of seeds per URL and ``bucket`` of seeds.

    Seeds are numbered by host, so that those which can reach a URL, all of its host,
    share few buckets.
    """
    seeds = cut_lineage(
        dense_numbers(
            frontier.select("seed_url", "key", url_host("seed_url").alias("host")),
            ["host", "seed_url"],
            "number",
        ).drop("host")
    )
    # The bitmap functions count from 1.
    place = F.col("number") + 1
    newest = seeds.groupBy("key", F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    newest = visited = cut_lineage(newest)
    found = []
    depth = 1
    while max_depth == 0 or depth < max_depth:
        depth += 1
        reached = (
            newest.join(links, "key")
            .groupBy(F.col("dst_key").alias("key"), F.col("dst_url").alias("url"), "bucket")
            .agg(F.bitmap_or_agg("bits").alias("bits"))
        )
        unseen = cut_lineage(_unseen(reached, visited))
        if unseen.isEmpty():
            break
        found.append(unseen.select("url", "bucket", "bits", F.lit(depth).alias("depth")))
        newest = _merged(unseen.select("key", "bucket", "bits"))
        visited = cut_lineage(_merged(visited.unionByName(newest)))
    start = frontier.select("seed_url", "url", "depth")
    if not found:
        return start
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    # A seed that reaches very many URLs is split by URL.
    pairs = salted_join(_seeds_of(rows), seeds.drop("key"), ["number"], ["url"])
    return start.unionByName(pairs.select("seed_url", "url", "depth"))


def _merged(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.groupBy("key", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _unseen(reached: DataFrame, visited: DataFrame) -> DataFrame:
    """Of ``key, url, bucket, bits``, the seeds that did not visit ``key`` before.

    Spellings of one key, which differ in the fragment, come in their order: a seed
    counts for the first one that it reaches. Rows are streamed; a task holds one bitmap.
    """
    rows = reached.select("key", "bucket", "url", "bits").unionByName(
        visited.select("key", "bucket", F.lit(None).cast("string").alias("url"), "bits")
    )

    def subtract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, None
        for batch in batches:
            keep, bits = [], []
            names = zip(*(batch.column(k).to_pylist() for k in range(3)))
            for row, (key, bucket, url) in enumerate(names):
                own = np.frombuffer(batch.column(3)[row].as_buffer(), np.uint8)
                if (key, bucket) != last:
                    last, seen = (key, bucket), np.zeros(len(own), np.uint8)
                new = own & ~seen
                seen = seen | own
                if url is not None and new.any():
                    keep.append(row)
                    bits.append(new.tobytes())
            kept = batch.take(pa.array(keep, pa.int64()))
            yield kept.set_column(3, "bits", pa.array(bits, pa.binary()))

    # Null URLs, the visited ones, are first.
    return (
        rows.repartition("key", "bucket")
        .sortWithinPartitions("key", "bucket", F.asc_nulls_first("url"))
        .mapInArrow(subtract, rows.schema)
    )


def _seeds_of(rows: DataFrame) -> DataFrame:
    """``number, url, depth`` for every seed in the bitmaps."""
    schema = pa.schema([("number", pa.int64()), ("url", pa.string()), ("depth", pa.int32())])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, rows, size = [], [], 0

        def flushed(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = pa.array(np.repeat(rows, [len(n) for n in numbers]))
            columns = [pa.array(np.concatenate(numbers)), batch["url"].take(at), batch["depth"].take(at)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            buckets = batch["bucket"].to_pylist()
            for row, bucket in enumerate(buckets):
                own = np.frombuffer(batch["bits"][row].as_buffer(), np.uint8)
                bits = np.flatnonzero(np.unpackbits(own, bitorder="little"))
                numbers.append(bits + (bucket - 1) * _BITMAP_BITS)
                rows.append(row)
                size += len(bits)
                if size >= _PAIRS_PER_BATCH:
                    yield flushed(batch)
                    numbers, rows, size = [], [], 0
            if rows:
                yield flushed(batch)
                numbers, rows, size = [], [], 0

    return rows.mapInArrow(expand, "number long, url string, depth int")


def pages_in_frontier(pages: DataFrame, frontier: DataFrame) -> DataFrame:
    """Fetched pages, without failed ones, whose URL was visited."""
    keys = frontier.select(_visit_key("url").alias("_key")).distinct()
    return (
        drop_http_errors(pages)
        .withColumn("_key", _visit_key("url"))
        .join(keys, "_key", "left_semi")
        .drop("_key")
    )


def crawl(
    pages: DataFrame, seeds: DataFrame, max_depth: int, follow_links: bool = True
) -> DataFrame:
    """Pages reached from the seeds, each tagged with its ``seed_url`` and ``depth``."""
    good = drop_http_errors(pages)
    frontier = crawl_frontier(seeds, extract_links(good), max_depth, follow_links)
    keyed = frontier.select("seed_url", "depth", _visit_key("url").alias("_key"))
    order = ["url", F.desc("scraped_at"), F.xxhash64("body")]
    one_per_key = first_per_key(good.withColumn("_key", _visit_key("url")), ["_key"], order)
    # A page that very many seeds reach is split by seed.
    return salted_join(keyed, one_per_key, ["_key"], ["seed_url"]).drop("_key")
