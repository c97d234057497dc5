import json
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusloom import functions as fn
from corpusloom.operators.analysis import FIELD_ANALYZERS, build_index
from corpusloom.operators.documents import build_documents
from corpusloom.operators.lookup import get_document, get_many
from corpusloom.operators.metrics import run_metrics, run_totals, split_errors
from corpusloom.schemas import DOCUMENT_SCHEMA, PAGE_SCHEMA, SOURCE_SCHEMA
from corpusloom.sinks import (
    compact_documents,
    create_document_table,
    drop_document_table,
    hits_preview,
    hits_to_json,
    manifest_rows,
    open_index,
    read_document_table,
    stage_pages,
    upsert_documents,
    write_manifests,
)
from corpusloom.sinks import table
from corpusloom.sinks.versions import live_versions
from corpusloom.sources import (
    scan_manifests,
    scan_pages,
    scan_staged_pages,
    scan_staged_table,
    select_sources,
)
from corpusloom.streaming import (
    IngestOptions,
    ingest_prefix,
    stream_ingest,
    stream_manifests,
)
from corpusloom.streaming.ingest import ingest_manifests

PREFIX = "scrapes/h.example:80/2024-01-02T03-04-05-0123abcd"
PORTS = IngestOptions(recursive=True)
OTHER = "scrapes/o.example/2024-01-03T03-04-05-89abcdef"


def doc(name, at=1, title="t", **more):
    fields = dict.fromkeys(DOCUMENT_SCHEMA.names)
    fields |= {"id": name, "url": f"u/{name}", "title": title, "content": f"content of {name}",
               "content_type": "", "scraped_at": datetime(2024, 1, at)}
    return tuple((fields | more)[n] for n in DOCUMENT_SCHEMA.names)


def titles(frame):
    return {r["id"]: r["title"] for r in frame.collect()}


def write_tree(root, prefix, pages, listed=None, indent=None):
    """A staged scrape as Markdown objects with its manifest."""
    folder = root / prefix / "pages"
    folder.mkdir(parents=True)
    for url, text in pages.items():
        name = url if url.endswith(".txt") else __import__("hashlib").sha256(url.encode()).hexdigest()[:16] + ".md"
        (folder / name).write_text(text)
    listed = list(pages) if listed is None else listed
    manifest = {"source_url": "https://h.example/", "timestamp": "2024-01-02T03:04:05Z",
                "page_count": len(listed), "pages": listed}
    (root / prefix / "metadata.json").write_text(json.dumps(manifest, indent=indent))


@pytest.fixture
def tree(tmp_path):
    write_tree(tmp_path, PREFIX, {"https://h.example:80/a": "# A\n\ntext", "https://h.example:80/b": "<title>B</title><p>b",
                                  "https://h.example:80/c": "unlisted", "notes.txt": "no page"},
               listed=["https://h.example:80/a", "https://h.example:80/b"], indent=2)
    write_tree(tmp_path, OTHER, {"https://o.example/": "- list"})
    return str(tmp_path)


def test_scans_of_a_tree(spark, tree):
    pages = scan_staged_pages(spark, tree)
    assert {r["scrape_prefix"] for r in pages.collect()} == {PREFIX, OTHER} and pages.count() == 4
    one = scan_staged_pages(spark, tree, PREFIX)
    assert sorted(r["content"] for r in one.collect()) == ["# A\n\ntext", "<title>B</title><p>b", "unlisted"]
    assert all(r["file_name"].endswith(".md") and "/" not in r["file_name"] for r in one.collect())
    row = scan_manifests(spark, tree, PREFIX).first()
    assert (row["source_url"], row["page_count"], len(row["pages"])) == ("https://h.example/", 2, 2)
    assert row["timestamp"] == datetime(2024, 1, 2, 3, 4, 5) and row["scrape_prefix"] == PREFIX
    assert scan_manifests(spark, tree, recursive=True).count() == 2


def test_ingest_of_a_tree(spark, tree, tmp_path):
    table = str(tmp_path / "table")
    result = ingest_prefix(spark, tree, table, PREFIX)
    assert (result.scrapes, result.pages, result.docs_indexed, result.errors) == (1, 3, 3, 0)
    rows = {r["url"]: r for r in read_document_table(spark, table).collect()}
    unlisted = next(u for u in rows if u.endswith(".md"))
    assert rows["https://h.example:80/a"]["title"] == "A"
    assert rows["https://h.example:80/b"]["title"] == "B" and rows["https://h.example:80/b"]["content"] == "b"
    # An unlisted file takes its name as URL and passes as Markdown.
    assert rows[unlisted]["title"] == unlisted and rows[unlisted]["content"] == "unlisted"
    assert {r["scraped_at"] for r in rows.values()} == {datetime(2024, 1, 2, 3, 4, 5)}
    before = sorted(map(str, rows.values()))
    ingest_prefix(spark, tree, table, PREFIX)
    assert sorted(map(str, read_document_table(spark, table).collect())) == before
    with pytest.raises(Exception):
        ingest_prefix(spark, tree, table, "scrapes/none/none")


def test_stream_equals_batch_and_survives_a_bad_scrape(spark, tree, tmp_path):
    bad = tmp_path / "scrapes" / "bad.example" / "2024-01-04T00-00-00-00000000"
    bad.mkdir(parents=True)
    (bad / "metadata.json").write_text('{"source_url": "x", "timestamp": "2024-01-04T00:00:00Z", "page_count": 1, "pages": ["p"]}')
    results = []
    table, progress = str(tmp_path / "streamed"), str(tmp_path / "progress")
    stream_ingest(spark, tree, table, progress, PORTS, max_files=1, on_result=results.append).awaitTermination()
    assert sum(r.docs_indexed for r in results) == 4
    assert [f for r in results for f in r.failed] == [
        ("scrapes/bad.example/2024-01-04T00-00-00-00000000", "no staged pages")
    ]
    assert spark.read.parquet(f"{table}/failed_scrapes").count() == 1
    batch = str(tmp_path / "batch")
    for prefix in (PREFIX, OTHER):
        ingest_prefix(spark, tree, batch, prefix)
    assert sorted(map(str, read_document_table(spark, table).collect())) == sorted(
        map(str, read_document_table(spark, batch).collect())
    )
    # Nothing new: the stream ends without work; a new scrape is picked up.
    count = len(results)
    stream_ingest(spark, tree, table, progress, PORTS, on_result=results.append).awaitTermination()
    assert len(results) == count
    write_tree(tmp_path, "scrapes/n.example/2024-01-05T00-00-00-11111111", {"https://n.example/": "# New"})
    stream_ingest(spark, tree, table, progress, PORTS, on_result=results.append).awaitTermination()
    assert results[-1].docs_indexed == 1 and read_document_table(spark, table).count() == 5


def test_the_stream_keeps_the_index_current(spark, tree, tmp_path):
    table, index = str(tmp_path / "indexed"), str(tmp_path / "index")
    stream_ingest(spark, tree, table, str(tmp_path / "at"), PORTS, max_files=1, index=index).awaitTermination()

    def same():
        fresh = build_index(read_document_table(spark, table), FIELD_ANALYZERS)
        for name in ("postings", "lengths", "term_stats"):
            mine, want = getattr(open_index(spark, index), name), getattr(fresh, name)
            assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, want.collect())), name

    same()
    deltas = live_versions(spark, index, "lengths/_SUCCESS")[1]
    assert [v.batch for v in deltas] == ["0", "1"]
    # Batch 0 comes again.
    replayed = scan_manifests(spark, tree, PREFIX)
    ingest_manifests(spark, tree, table, replayed, replace(PORTS, index=index), "0")
    same()
    deltas = live_versions(spark, index, "lengths/_SUCCESS")[1]
    assert [v.batch for v in deltas] == ["1", "0"]


def test_manifest_stream_is_a_stream(spark, tree):
    assert stream_manifests(spark, tree, recursive=True).isStreaming


@pytest.fixture
def scraped(spark):
    rows = [(f"https://h.example/{n}", 200, "text/html", f"<h1>{n}</h1>", datetime(2024, 1, 1 + n % 3)) for n in range(20)]
    return spark.createDataFrame(rows, PAGE_SCHEMA).withColumns(
        {"source_url": F.lit("https://h.example/"),
         "scrape_prefix": F.when(F.substring_index("url", "/", -1).cast("int") < 17, PREFIX).otherwise(OTHER)})


def test_manifests_are_split_when_large(scraped):
    rows = manifest_rows(scraped, max_pages=4).collect()
    large = [r for r in rows if r["scrape_prefix"] == PREFIX]
    assert {r["parts"] for r in large} == {5} and {r["page_count"] for r in large} == {17}
    assert sorted(u for r in rows for u in r["pages"]) == sorted(r["url"] for r in scraped.collect())
    small = [r for r in rows if r["scrape_prefix"] == OTHER]
    assert [(r["parts"], r["part"], r["page_count"]) for r in small] == [(1, 0, 3)]
    assert {r["timestamp"] for r in large} == {datetime(2024, 1, 3)}


def test_staged_table_layout(spark, scraped, tmp_path):
    root, table = str(tmp_path), str(tmp_path / "table")
    for _ in range(2):  # staging the same run again replaces it
        stage_pages(scraped, root)
    write_manifests(scraped, root, max_pages=4)
    assert scan_staged_table(spark, root).count() == 20
    assert scan_staged_table(spark, root, OTHER).count() == 3
    some = spark.createDataFrame([(OTHER,), ("scrapes/none/run",)], "scrape_prefix string")
    assert scan_staged_table(spark, root, some).count() == 3
    options = IngestOptions(layout="table")
    assert ingest_prefix(spark, root, table, OTHER, options).docs_indexed == 3
    stream_ingest(spark, root, table, str(tmp_path / "progress"), options).awaitTermination()
    rows = read_document_table(spark, table).collect()
    assert {r["content"] for r in rows} == {f"# {n}" for n in range(20)} and len(rows) == 20


def test_one_prefix_is_a_partition_filter(spark, scraped, tmp_path, capsys):
    stage_pages(scraped, str(tmp_path))
    scan_staged_table(spark, str(tmp_path), OTHER).explain("formatted")
    assert "PartitionFilters: [isnotnull(host" in capsys.readouterr().out


def test_table_upserts(spark, tmp_path):
    root = str(tmp_path / "t")
    frame = lambda *rows: spark.createDataFrame(list(rows), DOCUMENT_SCHEMA)
    drop_document_table(spark, root)
    create_document_table(spark, root)
    create_document_table(spark, root)
    assert read_document_table(spark, root).count() == 0
    upsert_documents(spark, frame(doc("a"), doc("b"), doc("a", 2, "t2")), root)
    assert titles(read_document_table(spark, root)) == {"a": "t2", "b": "t"}
    upsert_documents(spark, frame(doc("b", 3, "t3"), doc("c"), doc("a", 1, "old")), root)
    want = {"a": "t2", "b": "t3", "c": "t"}
    assert titles(read_document_table(spark, root)) == want
    compact_documents(spark, root)
    assert titles(read_document_table(spark, root)) == want
    create_document_table(spark, root)
    assert titles(read_document_table(spark, root)) == want
    upsert_documents(spark, frame(doc("b", 3, "same time"), doc("c", 9, "t9")), root)
    assert titles(read_document_table(spark, root)) == want | {"b": "same time", "c": "t9"}
    drop_document_table(spark, root)
    with pytest.raises(FileNotFoundError):
        read_document_table(spark, root)


def test_unfinished_versions_are_not_read(spark, tmp_path):
    root = str(tmp_path / "t")
    upsert_documents(spark, spark.createDataFrame([doc("a")], DOCUMENT_SCHEMA), root)
    spark.createDataFrame([doc("z")], DOCUMENT_SCHEMA).write.parquet(f"{root}/delta-0000000002")
    (tmp_path / "t" / "delta-0000000002" / "_SUCCESS").unlink()
    assert set(titles(read_document_table(spark, root))) == {"a"}
    upsert_documents(spark, spark.createDataFrame([doc("b")], DOCUMENT_SCHEMA), root)
    assert set(titles(read_document_table(spark, root))) == {"a", "b"}


def test_only_the_caller_compacts(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(4):
        upsert_documents(spark, spark.createDataFrame([doc(f"d{n}"), doc("x", 1 + n, f"t{n}")], DOCUMENT_SCHEMA), root)
    bases = lambda: [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("base")]
    assert len(bases()) == 1
    before = titles(read_document_table(spark, root))
    compact_documents(spark, root)
    # Older and equally old rows of a replayed batch.
    upsert_documents(spark, spark.createDataFrame([doc("x", 2, "old"), doc("d1", 1, "again")], DOCUMENT_SCHEMA), root)
    assert len(bases()) == 2 and before["x"] == "t3"
    assert titles(read_document_table(spark, root)) == before | {"d1": "again"}
    compact_documents(spark, root)
    assert titles(read_document_table(spark, root)) == {"d0": "t", "d1": "again", "d2": "t", "d3": "t", "x": "t3"}


def test_lookup(spark, tmp_path, capsys):
    root = str(tmp_path / "t")
    upsert_documents(spark, spark.createDataFrame([doc("a"), doc("b")], DOCUMENT_SCHEMA), root)
    compact_documents(spark, root)
    table = read_document_table(spark, root)
    assert get_document(table, "a").first()["content"] == "content of a"
    assert get_document(table, "none").count() == 0
    get_document(table, "a").explain("formatted")
    assert "EqualTo(id,a)" in capsys.readouterr().out
    ids = spark.createDataFrame([("b",), ("x",), ("b",)], "id string")
    assert {(r["id"], r["found"], r["title"]) for r in get_many(table, ids).collect()} == {("b", True, "t"), ("x", False, None)}


def test_json_rows(spark):
    full = doc("a", tags=["x", "y"], summary="s", embedding=[0.5, 1.0])
    bare = doc("b", tags=[], summary="", content='quote " and\nline')
    rows = [json.loads(r["document"]) for r in hits_to_json(spark.createDataFrame([full, bare], DOCUMENT_SCHEMA)).collect()]
    assert list(rows[0]) == DOCUMENT_SCHEMA.names
    assert rows[0]["tags"] == ["x", "y"] and rows[0]["embedding"] == [0.5, 1.0]
    assert list(rows[1]) == ["id", "url", "title", "content", "content_type", "scraped_at"]
    assert rows[1]["content"] == 'quote " and\nline' and rows[1]["scraped_at"].startswith("2024-01-01T00:00:00")


def test_preview(spark):
    contents = ["x" * 500, "x" * 501, "é" * 251]
    rows = [doc(str(n), content=c) for n, c in enumerate(contents)]
    shown = hits_preview(spark.createDataFrame(rows, DOCUMENT_SCHEMA)).orderBy("id").collect()
    assert [r["content"] for r in shown] == ["x" * 500, "x" * 500 + "...", "é" * 250 + "..."]


def test_seeds(spark):
    sources = spark.createDataFrame([("a", "https://a.example/"), ("b", ""), ("c", "https://c.example/")], SOURCE_SCHEMA)
    assert select_sources(sources).count() == 2
    assert select_sources(sources, name="c").first()["url"] == "https://c.example/"
    assert select_sources(sources, name="c", url="https://x.example/").first()["url"] == "https://x.example/"
    for empty in ({"name": "b"}, {"name": "none"}):
        with pytest.raises(ValueError, match="no source named"):
            select_sources(sources, **empty)
    with pytest.raises(ValueError, match="no source has a url"):
        select_sources(sources.where("name = 'b'"))
    with pytest.raises(ValueError, match="no sources given"):
        select_sources(sources.limit(0))


def test_counters(spark):
    rows = spark.createDataFrame([("p", None), ("p", "e"), ("q", None)], "scrape_prefix string, error string")
    assert {tuple(r) for r in run_metrics(rows).collect()} == {("p", 2, 1, 1), ("q", 1, 1, 0)}
    assert (None, 3, 2, 1) in {tuple(r) for r in run_totals(rows).collect()}
    good, bad = split_errors(rows)
    assert (good.count(), bad.count(), good.columns) == (2, 1, ["scrape_prefix"])


def test_glob_of_manifests(spark, tmp_path):
    write_tree(tmp_path, OTHER, {"https://o.example/": "- list"})
    assert scan_manifests(spark, str(tmp_path)).first()["scrape_prefix"] == OTHER
    assert stream_manifests(spark, str(tmp_path)).isStreaming


def test_documents(spark, tmp_path):
    # Defined here so that the workers get them by value.
    def text_factory():
        def model(titles, contents):
            if "boom" in titles:
                raise RuntimeError("model down")
            return [(f"{t}, tag ,", f" about {t} ({len(c)}) ") for t, c in zip(titles, contents)]

        return model

    def vector_factory():
        def model(texts):
            return [[1.0, 2.0, 3.0] if "long" in t else [1.0, 2.0] for t in texts]

        return model

    rows = [
        ("https://h.example/md", 200, "text/markdown", "plain body", datetime(2024, 1, 1)),
        ("https://h.example/h", 200, "text/html", "<title>boom</title><p>x</p>", datetime(2024, 1, 1)),
        ("https://h.example/long", 200, "", "# Title\nlong " + "y" * 30_000, datetime(2024, 1, 1)),
        ("https://h.example/null", 200, None, None, None),
    ]
    spark.createDataFrame(rows, PAGE_SCHEMA).write.parquet(str(tmp_path / "pages"))
    pages = scan_pages(spark, str(tmp_path / "pages"))
    built = build_documents(pages, text_factory, vector_factory, dims=2)
    assert built.columns == [*DOCUMENT_SCHEMA.names, "error"]
    by_url = {r["url"].rsplit("/", 1)[1]: r for r in built.collect()}
    assert by_url["md"]["title"] == "https://h.example/md" and by_url["md"]["content"] == "plain body"
    assert by_url["h"]["title"] == "boom" and by_url["h"]["content"] == "x"
    # The failed call leaves tags and summary empty, the document stays.
    assert by_url["h"]["tags"] is None and by_url["h"]["summary"] is None and by_url["h"]["error"] is None
    assert by_url["long"]["tags"] == ["Title", "tag"] and by_url["long"]["summary"] == "about Title (30013)"
    cut = build_documents(pages, text_factory, max_bytes=20_000).where("summary like '%(20000)'")
    assert cut.count() == 1
    assert by_url["long"]["embedding"] is None and "expected 2 values, got 3" in by_url["long"]["error"]
    assert by_url["md"]["embedding"] == [1.0, 2.0] and by_url["null"]["content"] == ""
    plain = build_documents(pages)
    assert plain.where("tags is not null or summary is not null or embedding is not null").count() == 0
    assert plain.where(F.col("id") != fn.document_id("url")).count() == 0


def test_disabled_stages_are_not_planned(scraped, capsys):
    build_documents(scraped).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_one_page_end_to_end(spark):
    from corpusloom.operators.bm25 import search

    html = ("<!doctype html><html><head><title>Manual</title></head><body><h1>Start</h1><h2>Installation</h2>"
            "<p>Type this to install:</p><pre><code>tool get it</code></pre></body></html>")
    pages = spark.createDataFrame([("https://h.example/", 200, "text/html", html, datetime(2024, 1, 1))], PAGE_SCHEMA)
    documents, bad = split_errors(build_documents(pages))
    assert bad.count() == 0
    hit = search(documents, "install").first()
    assert hit["url"] == "https://h.example/" and hit["title"] == "Manual" and "tool get it" in hit["content"]


def test_an_upsert_regroups_only_repeated_ids(spark, tmp_path, monkeypatch):
    root, asked = str(tmp_path / "table"), []
    original = table.latest_by_id
    monkeypatch.setattr(table, "latest_by_id", lambda df, *order: asked.append(df.count()) or original(df, *order))
    upsert_documents(spark, spark.createDataFrame([doc("a"), doc("b")], DOCUMENT_SCHEMA), root)
    assert not asked
    rows = [doc("a", 2, "t2"), doc("a", 1), doc("c", 1, "once")]
    upsert_documents(spark, spark.createDataFrame(rows, DOCUMENT_SCHEMA), root)
    assert asked == [2]
    assert len(live_versions(spark, root)[1]) == 2
    last = spark.read.parquet(live_versions(spark, root)[1][-1].path)
    assert titles(last) == {"a": "t2", "c": "once"}
