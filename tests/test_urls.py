from urllib.parse import urljoin

import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from corpusloom import functions as fn
from corpusloom.functions.models import MODEL_INPUT_BYTES


def test_document_id(column):
    urls = ["https://h.example/", "https://h.example", "é"]
    ids = column(fn.document_id, urls)
    assert ids == [hashlib.sha256(u.encode()).hexdigest()[:16] for u in urls]
    assert len(set(ids)) == 3 and {len(i) for i in ids} == {16}


def test_hosts(column):
    cases = {
        "https://h.example:8443/a?b=c": "h.example:8443",
        "http://user:pw@h.example/": "h.example",
        "not a url": None,
        "/relative": None,
    }
    assert column(fn.url_host, list(cases)) == list(cases.values())


def test_variants(column):
    cases = {
        "https://h.example/guide/start": ["https://h.example/guide/start.md"],
        "https://h.example/guide//": ["https://h.example/guide/.md"],
        "https://h.example/guide/?q=1": ["https://h.example/guide/?q=1.md"],
        "https://github.com/o/r/blob/dev/a.md": ["https://raw.githubusercontent.com/o/r/dev/a.md"],
        "https://github.com/o/r/blob/x/blob/github.com": [
            "https://raw.githubusercontent.com/o/r/x/blob/github.com"
        ],
        "https://github.com/o/r": ["https://github.com/o/r.md"],
        "https://h.example/a.md": [],
        "https://h.example/a.Markdown": [],
    }
    assert column(fn.markdown_url_variants, list(cases)) == list(cases.values())


def test_absolute_urls(column):
    page = "https://h.example/a/b?x=1#f"
    cases = {
        "/c": "https://h.example/c",
        "c/d": "https://h.example/a/c/d",
        "../c": "https://h.example/c",
        "/a/../c": "https://h.example/c",
        "?y=2": "https://h.example/a/b?y=2",
        "//o.example/z": "https://o.example/z",
        "http://o.example/": "http://o.example/",
        "mailto:me@o.example": "mailto:me@o.example",
        "#top": None,
        "/é x": "https://h.example/%C3%A9%20x",
        "http://[bad": "http://[bad",
    }
    assert column(fn.absolute_url, [(page, href) for href in cases]) == list(cases.values())


def test_object_keys(spark):
    at = F.lit("2024-01-02 03:04:05").cast("timestamp")
    url = F.lit("https://h.example:81/x")
    prefix = fn.scrape_prefix(url, at)
    nanos = int(datetime.fromisoformat("2024-01-02T03:04:05+00:00").timestamp()) * 10**9
    short = hashlib.sha256(f"https://h.example:81/x-{nanos}".encode()).hexdigest()[:8]
    row = spark.range(1).select(
        prefix, fn.object_key(prefix, F.lit("0a")), fn.manifest_key(prefix),
        fn.object_name(fn.object_key(prefix, F.lit("0a"))),
    ).first()
    want = f"scrapes/h.example:81/2024-01-02T03-04-05-{short}"
    assert list(row) == [want, f"{want}/pages/0a.md", f"{want}/metadata.json", "0a.md"]


def test_model_facts(column):
    names = ["ai/embeddinggemma", "ai/snowflake-arctic-embed", "ai/qwen3-embedding", "unknown"]
    assert column(fn.embedding_dims, names) == [768, 1024, 2560, 768]
    cut = lambda title, content: fn.enrichment_prompts(title, content, MODEL_INPUT_BYTES)
    for prompts, size in ((cut, 20_000), (fn.enrichment_prompts, 30_000)):
        for prompt in column(prompts, [("My title", "x" * 30_000)])[0]:
            assert "My title" in prompt and prompt.endswith("x" * size) and "x" * (size + 1) not in prompt


def test_links_resolve_as_in_the_library(column):
    pages = [f"https://h.example.org{tail}" for tail in ("", "/", "/a", "/a/", "/a/b/c.html", "/a//b/c?q=1/2#f", "/a/../b/./c/", "?x=/y")]
    hrefs = "x ./x ../x ../../x ../../../x . .. ./ ../ ... x/. x/.. x/../y ./../x a//b ../a//b/ ?q ?q=../z x?q=./y#z x#../y x# x? "
    hrefs += "/ /x /. /.. /../x /a/./b/../c /a//../b /x/.. /x/../.. /a/..?q /a/../b#c /a/b/../../../c x/y/../../../z ..x x.. .x /..x/y"
    cases = [(page, href) for page in pages for href in hrefs.split()]
    wanted = [urljoin(*case) for case in cases]
    # An absolute path without dots stays as it stands.
    assert column(fn.absolute_url, cases) == wanted and len(cases) > 300


def test_odd_links(column):
    base = "https://h.example.org/a/b"
    cases = {" x ": "https://h.example.org/a/x", "x\ny\t": "https://h.example.org/a/xy", "": base, "#x": None, "\n#x": None}
    assert column(fn.absolute_url, [(base, href) for href in cases]) == list(cases.values())
    assert column(fn.absolute_url, [("mailto:x", "y"), (None, "y"), ("http://h", None)]) == ["y", None, None]


def test_character_references(column):
    cases = {
        "/a?b=1&amp;c=2": "/a?b=1&c=2",
        "/a&#47;b&#x2F;c&#X2f": "/a/b/c/",
        "/caf&eacute;&Eacute;&hellip;": "/caf\u00e9\u00c9\u2026",
        "?a&copy=1&copy;&copy&copyx&copy": "?a&copy=1\u00a9\u00a9&copyx\u00a9",
        "&#128;&#0;&#xD800;&#99999999;&#x1F600;": "\u20ac\ufffd\ufffd\ufffd\U0001f600",
        "&unknown;&;&#;&#x;&&amp": "&unknown;&;&#;&#x;&&",
        "": "",
        "plain": "plain",
    }
    assert column(fn.decode_references, list(cases)) == list(cases.values())
    assert column(fn.decode_references, [(None,)]) == [None]
