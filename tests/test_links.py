import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import links
from corpusloom.operators.links import (
    crawl,
    crawl_frontier,
    extract_links,
    pages_in_frontier,
)
from corpusloom.operators.variants import prefer_markdown_variant
from corpusloom.plans import dense_numbers
from corpusloom.schemas import PAGE_SCHEMA
from corpusloom.sources import drop_http_errors

SITE = "https://h.example"


def page(path, links=(), status=200, content_type="text/html", body=None):
    html = "<body>" + "".join(f'<a class="x" href="{link}">{link}</a>' for link in links) + "</body>"
    return (SITE + path, status, content_type, html if body is None else body, None)


def frame(spark, rows):
    return spark.createDataFrame(rows, PAGE_SCHEMA)


def depths(frontier):
    return {r["url"].removeprefix(SITE): r["depth"] for r in frontier.collect()}


def seeds(spark, *paths):
    return spark.createDataFrame([(SITE + p,) for p in paths], "url string")


def test_links(spark):
    rows = [
        page("/", ["/a", "b?x=1&amp;y=2", "/a", "#top", "https://o.example/", "mailto:x@o.example", ""]),
        page("/text", content_type="text/plain", body="<a href='/no'>"),
        page("/odd", body="<A HREF=/bare>x</A><a\nid=q\nhref='/single'>y</a><a data-href='/no'>z</a>"),
    ]
    found = {(r.src_url.removeprefix(SITE), r.dst_url.removeprefix(SITE)) for r in extract_links(frame(spark, rows)).collect()}
    assert found == {("/", "/a"), ("/", "/b?x=1&y=2"), ("/odd", "/bare"), ("/odd", "/single")}
    assert extract_links(frame(spark, rows), same_host=False).count() == 6


def test_depth_bound(spark):
    chain = [page("/", ["/one"]), page("/one", ["/two"]), page("/two", ["/three"]), page("/three")]
    edges = extract_links(frame(spark, chain))
    start = seeds(spark, "/")
    assert depths(crawl_frontier(start, edges, 1)) == {"/": 1}
    assert depths(crawl_frontier(start, edges, 2)) == {"/": 1, "/one": 2}
    assert depths(crawl_frontier(start, edges, 0)) == {"/": 1, "/one": 2, "/two": 3, "/three": 4}
    assert depths(crawl_frontier(start, edges, 3, follow_links=False)) == {"/": 1}


def test_every_url_is_visited_once_at_its_least_depth(spark):
    rows = [page("/", ["/a", "/b"]), page("/a", ["/b#part", "/", "/c"]), page("/b", ["/c#x", "/c"]), page("/c", ["/a"])]
    edges = extract_links(frame(spark, rows))
    assert depths(crawl_frontier(seeds(spark, "/"), edges, 0)) == {"/": 1, "/a": 2, "/b": 2, "/c": 3}


def test_crawl_keeps_fetched_pages_without_errors(spark):
    rows = [page("/", ["/ok", "/bad", "/missing"]), page("/ok"), page("/bad", ["/behind"], status=500), page("/behind")]
    pages = frame(spark, rows)
    assert drop_http_errors(pages).count() == 3
    reached = crawl(pages, seeds(spark, "/"), 3)
    assert depths(reached) == {"/": 1, "/ok": 2}
    frontier = crawl_frontier(seeds(spark, "/"), extract_links(pages), 2)
    assert {r["url"].removeprefix(SITE) for r in pages_in_frontier(pages, frontier).collect()} == {"/", "/ok"}


def test_copies_of_a_page_count_once(spark):
    pages = frame(spark, [page("/", ["/a"])] * 40 + [page("/a")] * 30)
    assert depths(crawl(pages, seeds(spark, "/"), 2)) == {"/": 1, "/a": 2}
    assert crawl(pages, seeds(spark, "/"), 2).count() == 2


def test_seeds_are_followed_apart(spark):
    rows = [page("/", ["/a"]), page("/a", ["/b"]), page("/b")]
    frontier = crawl_frontier(seeds(spark, "/", "/a"), extract_links(frame(spark, rows)), 2)
    found = {(r.seed_url.removeprefix(SITE), r.url.removeprefix(SITE), r.depth) for r in frontier.collect()}
    assert found == {("/", "/", 1), ("/", "/a", 2), ("/a", "/a", 1), ("/a", "/b", 2)}


def test_markdown_variants(spark):
    rows = [
        page("/plain"),
        page("/plain.md", content_type="text/markdown", body="no patterns"),
        page("/slash/"),
        page("/slash.md", content_type="text/plain", body="# Slash"),
        page("/gone"),
        page("/gone.md", status=404, body="# Gone"),
        page("/alone"),
        page("/twice"),
        page("/twice.md", content_type="", body="# B"),
        page("/twice.md", content_type="", body="# A"),
    ] + [page("/plain")] * 50
    chosen = prefer_markdown_variant(frame(spark, rows))
    assert chosen.count() == len(rows) and chosen.columns == PAGE_SCHEMA.names
    bodies = {r.url.removeprefix(SITE): (r.content_type, r.body) for r in chosen.collect()}
    assert bodies["/plain"] == ("text/markdown", "no patterns")
    assert bodies["/slash/"] == ("text/plain", "# Slash")
    assert bodies["/gone"][0] == "text/html" and bodies["/alone"][0] == "text/html"
    assert bodies["/twice"] == ("", "# A")
    assert chosen.where(F.col("url") == SITE + "/plain").select("body").distinct().count() == 1


def test_a_crawl_without_a_bound_ends_by_itself_only(spark):
    """Deeper than any fixed number of rounds would be: the chain is followed to its end."""
    chain = [(f"https://h.example/{n}", f"https://h.example/{n + 1}") for n in range(53)]
    edges = spark.createDataFrame(chain, "src_url string, dst_url string")
    seeds = spark.createDataFrame([("https://h.example/0",)], "url string")
    found = crawl_frontier(seeds, edges, 0).collect()
    assert sorted(row["depth"] for row in found) == list(range(1, 55))


@pytest.mark.parametrize("max_depth", [0, 2, 3, 5])
def test_bitmaps_equal_pairs(spark, max_depth):
    """Every page a seed, on several hosts, with cycles, hubs and spellings of one page."""
    rng = random.Random(max_depth)
    pages = [f"https://h{n % 3}.example/p{n}" for n in range(120)]
    edges = []
    for n, page in enumerate(pages):
        for _ in range(rng.randrange(4)):
            other = pages[(n + 3 * rng.randrange(40)) % 120] if rng.random() < 0.9 else rng.choice(pages)
            edges.append((page, other + rng.choice(["", "#a", "#b"])))
        edges.append((page, f"https://h{n % 3}.example/hub#{n}"))
    edges += [("https://h0.example/hub", "https://h0.example/p0"), (pages[0], "https://h0.example/end")]
    edges = spark.createDataFrame(edges, "src_url string, dst_url string")
    seeds = spark.createDataFrame([(page,) for page in pages + [pages[0] + "#x"]], "url string")

    def reached(least):
        found = crawl_frontier(seeds, edges, max_depth, bitmap_seeds=least)
        return sorted(map(tuple, found.collect()))

    pairs = reached(10**9)
    assert len(pairs) > 300 and reached(0) == pairs


def test_a_round_of_bitmaps_has_a_row_per_url(spark, monkeypatch):
    pages = [f"https://h.example/{n}" for n in range(300)]
    edges = [(page, pages[(n * 7 + k) % 300]) for n, page in enumerate(pages) for k in (1, 2, 3)]
    sizes = []
    unseen = links._unseen
    monkeypatch.setattr(links, "_unseen", lambda *a: sizes.append(unseen(*a)) or sizes[-1])
    found = crawl_frontier(
        spark.createDataFrame([(p,) for p in pages], "url string"),
        spark.createDataFrame(edges, "src_url string, dst_url string"), 4, bitmap_seeds=0)
    assert found.count() > 20 * len(pages)
    assert [rows.count() for rows in sizes] == [300, 300, 300]


def test_dense_numbers(spark):
    frame = spark.range(1000).repartition(7).select((F.col("id") * 3).alias("k"))
    rows = dense_numbers(frame, ["k"], "number").collect()
    assert sorted((r["number"], r["k"]) for r in rows) == [(n, 3 * n) for n in range(1000)]
    assert dense_numbers(frame.where("k < 0"), ["k"], "number").count() == 0


def test_base_element_and_references(spark):
    anchor = "<a href='up/x?a=1&amp;b&#61;2'>x</a><a href='#top'>t</a><a href='/root'>r</a>"
    pages = spark.createDataFrame(
        [
            ("https://h.example.org/a/b", f"<head><BASE target=x HREF='/docs/v1/'></head>{anchor}", "text/html"),
            ("https://h.example.org/c/d", f"<base href='https://other.example.org/'>{anchor}", None),
            ("https://h.example.org/e/f", f"<base href=''><base target=_top>{anchor}", ""),
            ("https://h.example.org/g/g", f"<base href=' ../z/ '><base href='/no/'>{anchor}", ""),
        ],
        "url string, body string, content_type string",
    )
    links = extract_links(pages, same_host=False)
    found = {(row.src_url[-3:], row.dst_url) for row in links.collect()}
    h = "https://h.example.org"
    assert found == {
        ("a/b", f"{h}/docs/v1/up/x?a=1&b=2"), ("a/b", f"{h}/root"),
        ("c/d", "https://other.example.org/up/x?a=1&b=2"), ("c/d", "https://other.example.org/root"),
        ("e/f", f"{h}/e/up/x?a=1&b=2"), ("e/f", f"{h}/root"),
        ("g/g", f"{h}/z/up/x?a=1&b=2"), ("g/g", f"{h}/root"),
    }
    assert extract_links(pages).where("src_url like '%/c/d'").count() == 0
    assert "Python" not in links._jdf.queryExecution().toString()
