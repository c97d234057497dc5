import math
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.stemming import stem_words
from corpusloom.operators import analysis, bm25
from corpusloom.operators.analysis import (
    ENGLISH,
    STANDARD,
    analyze_text,
    build_index,
    build_postings,
    field_stats,
    present_fields,
    term_stats,
)
from corpusloom.operators.bm25 import search, search_index, search_many
from corpusloom.plans import hot_keys
from corpusloom.sinks import compact_index, create_index, open_index, update_index, write_index
from corpusloom.sinks.versions import live_versions, versions

DOCUMENTS = [
    ("a", "Setup guide", "# Setup\n\nInstall the tool with the package manager.", ["setup", "install"], None),
    ("b", "Settings", "# Settings\n\nThe tool reads its settings from variables.", None, "How to configure"),
    ("c", "People", "The people endpoint lists people and more people.", ["accounts list", "people"], None),
    ("d", "Empty", "", [], ""),
    ("e", "Copy", "The people endpoint lists people and more people.", None, None),
]
FIELDS = {"content": ENGLISH, "title": STANDARD, "tags": ENGLISH, "summary": ENGLISH}


@pytest.fixture(scope="module")
def documents(spark):
    schema = "id string, title string, content string, tags array<string>, summary string"
    return spark.createDataFrame(DOCUMENTS, schema).cache()


@pytest.fixture(scope="module")
def queries(spark):
    rows = [("q1", "installation of people"), ("q2", "settings"), ("q3", "nothing matches zzz"),
            ("q4", ""), ("q5", "people people tool"), ("q6", None)]
    return spark.createDataFrame(rows, "query_id string, query string")


def brute_force(spark, query, fields, boosts, k1=1.2, b=0.75):
    """Scores straight from the formula, document by document."""
    names = ["title", "content", "tags", "summary"]
    best = {}
    for field, analyzer in fields.items():
        tokens = {}
        for doc in DOCUMENTS:
            value = doc[1 + names.index(field)]
            values = value if isinstance(value, list) else [value or ""]
            tokens[doc[0]] = [t for v in values for t in analyze_text(spark, v, analyzer)]
        having = {d: t for d, t in tokens.items() if t}
        if not having:
            continue
        mean = sum(map(len, having.values())) / len(having)
        for doc, words in having.items():
            score = 0.0
            for term in analyze_text(spark, query, analyzer):
                df = sum(term in t for t in having.values())
                tf = words.count(term)
                if tf:
                    idf = math.log(1 + (len(having) - df + 0.5) / (df + 0.5))
                    score += idf * (k1 + 1) * tf / (tf + k1 * (1 - b + b * len(words) / mean))
            if score:
                best[doc] = max(best.get(doc, 0.0), score * boosts.get(field, 1.0))
    return sorted(((d, round(s, 6)) for d, s in best.items()), key=lambda x: (-x[1], x[0]))


def pairs(hits):
    rows = sorted(hits.collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    return [(r["id"], round(r["score"], 6)) for r in rows]


@pytest.mark.parametrize("query", ["installing the tool", "people people tool"])
def test_search_equals_the_formula(spark, documents, query):
    want = brute_force(spark, query, FIELDS, bm25.BOOSTS)
    assert pairs(search(documents, query, 10)) == want
    assert pairs(search_index(build_index(documents), query, 10)) == want


def test_expected_documents_are_found(documents):
    assert "a" in [d for d, _ in pairs(search(documents, "installation", 10))]
    assert "c" in [d for d, _ in pairs(search(documents, "person people", 10))]
    assert [d for d, _ in pairs(search(documents, "people", 10, {"content": ENGLISH}))] == ["c", "e"]


def test_parameters_matter(spark, documents):
    fields = {"content": STANDARD}
    want = brute_force(spark, "people tool", fields, {}, k1=0.5, b=0.1)
    assert pairs(search(documents, "people tool", 9, fields, {}, k1=0.5, b=0.1)) == want
    boosted = brute_force(spark, "people", {"title": STANDARD, "content": STANDARD}, {"title": 7.0})
    got = search(documents, "people", 9, {"title": STANDARD, "content": STANDARD}, {"title": 7.0})
    assert pairs(got) == boosted


def test_limits(documents):
    assert search(documents, "people", 0).count() == 0
    assert search(documents, "people", 1).count() == 1
    with pytest.raises(ValueError):
        search(documents, "people", -1)
    assert search(documents, "", 10).count() == 0


def test_many_equals_single(spark, documents, queries):
    index = build_index(documents)
    rows = search_many(index, queries, 3).collect()
    for query_id, query in queries.collect():
        want = pairs(search(documents, query or "", 3))
        mine = sorted((r for r in rows if r["query_id"] == query_id), key=lambda r: r["rank"])
        assert [(r["id"], round(r["score"], 6)) for r in mine] == want


def test_many_with_documents(documents, queries):
    hits = search_many(build_index(documents), queries, 2, documents=documents)
    assert hits.columns == ["query_id", "rank", "id", "score", "title", "content", "tags", "summary"]
    plain = search_many(build_index(documents), queries, 2)
    assert hits.count() == plain.count() > 0


def test_salted_join_gives_the_same_hits(documents, queries, monkeypatch):
    index = build_index(documents)
    want = sorted(search_many(index, queries, 5).collect())
    monkeypatch.setattr(bm25, "is_bounded", lambda df: False)
    original = bm25.hot_keys
    monkeypatch.setattr(bm25, "hot_keys", lambda *a: original(*a, hot_rows=1))
    assert sorted(search_many(index, queries, 5).collect()) == want


def test_stored_index(spark, documents, queries, tmp_path):
    index = build_index(documents)
    write_index(index, str(tmp_path / "index"))
    stored = open_index(spark, str(tmp_path / "index"))
    assert stored.fields == index.fields == FIELDS
    assert sorted(search_many(stored, queries, 5).collect()) == sorted(search_many(index, queries, 5).collect())
    hits = search_index(stored, "people tool", 5)
    assert pairs(hits) == pairs(search(documents, "people tool", 5))


def test_stored_index_prunes_terms(spark, documents, tmp_path, capsys):
    write_index(build_index(documents), str(tmp_path / "index"))
    stored = open_index(spark, str(tmp_path / "index"))
    search_index(stored, "people", 5).explain("formatted")
    plan = capsys.readouterr().out
    pushed = re.findall(r"PushedFilters: \[(.*)\]", plan)
    assert any("term" in p for p in pushed)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_index_updates(spark, documents, queries, tmp_path):
    """Changed, emptied and new documents; the index equals one built afresh."""
    root = str(tmp_path / "index")
    write_index(build_index(documents), root)
    schema = documents.schema
    first = spark.createDataFrame(
        [("b", "Settings", "people changed here", None, None), ("n", "New", "a new tool", ["tool"], None)], schema)
    second = spark.createDataFrame([("c", "", "", None, None), ("b", "Settings", "tool tool people", None, None)], schema)
    update_index(spark, first, root)
    update_index(spark, second, root)
    kept = documents.where("id not in ('b', 'c')").unionByName(first.where("id = 'n'"))
    fresh = kept.unionByName(second)

    def same():
        index = open_index(spark, root)
        assert sorted(search_many(index, queries, 9).collect()) == sorted(
            search_many(build_index(fresh), queries, 9).collect())

    same()
    compact_index(spark, root)
    same()


def test_standard_postings_are_a_narrow_operation(documents, capsys):
    build_postings(documents, {"content": STANDARD, "tags": STANDARD}).explain()
    assert "Exchange" not in capsys.readouterr().out


@pytest.mark.parametrize("bounded", [True, False])
def test_distinct_words_are_stemmed(spark, documents, monkeypatch, bounded):
    """Each word once, whether the vocabulary is broadcast or joined with salted words."""
    stemmed = []
    monkeypatch.setattr(analysis, "stem_words", lambda c: stemmed.append(c) or stem_words(c))
    if not bounded:
        monkeypatch.setattr(analysis, "broadcast_if_bounded", lambda df: (df, False))
        monkeypatch.setattr(analysis, "hot_keys", lambda c, k, n: hot_keys(c, k, n, hot_rows=1))
    rows = build_postings(documents, FIELDS).collect()
    assert len(stemmed) == 1
    want = {}
    for doc in documents.collect():
        for field, analyzer in FIELDS.items():
            value = doc[field]
            tokens = [t for v in (value if isinstance(value, list) else [value or ""])
                      for t in analyze_text(spark, v, analyzer)]
            for term in tokens:
                want[field, term, doc["id"]] = (tokens.count(term), len(tokens))
    assert {(r.field, r.term, r.id): (r.tf, r.len) for r in rows} == want and len(rows) == len(want)


def test_stemming_sees_one_row_per_word(documents, monkeypatch):
    written = []
    cut = analysis.cut_lineage
    monkeypatch.setattr(analysis, "cut_lineage", lambda df: written.append(df) or cut(df))
    build_postings(documents, FIELDS)
    vocabulary = written[-1]
    assert vocabulary.columns == ["term", "n", "stem"]
    plan = vocabulary._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Aggregate")


def test_word_forms(spark, documents):
    tokens = analysis.tokenize(documents, FIELDS)
    assert bm25.word_forms(tokens, FIELDS, {"set", "instal", "zzz"}) == {"set": ["settings"], "instal": ["install"]}
    assert bm25.word_forms(tokens, {"title": STANDARD}, {"set"}) == {}


def test_replayed_and_late_batches(spark, documents, queries, tmp_path):
    """A batch that comes again replaces its delta; an older version is not found."""
    root = str(tmp_path / "index")
    schema = "id string, title string, content string, tags array<string>, summary string, scraped_at timestamp"
    at = lambda day: datetime(2024, 1, day)
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    create_index(spark, root, FIELDS)
    create_index(spark, root, FIELDS)
    assert search_index(open_index(spark, root), "people", 5).count() == 0
    first = frame(("a", "People", "people", None, None, at(2)), ("b", "Tool", "tools", None, None, at(2)))
    second = frame(("a", "None", "nobody", None, None, at(3)), ("c", "Tool", "", [], None, None))
    late = frame(("a", "People", "people", None, None, at(1)), ("b", "Old", "old", None, None, None))

    def found(*rows):
        index = open_index(spark, root)
        fresh = build_index(frame(*rows), FIELDS)
        assert sorted(search_many(index, queries, 9).collect()) == sorted(search_many(fresh, queries, 9).collect())
        assert sorted(index.lengths.collect()) == sorted(fresh.lengths.collect())

    update_index(spark, first, root, batch="7")
    update_index(spark, second, root, batch="8")
    want = [second.collect()[0], first.collect()[1], second.collect()[1]]
    found(*want)
    numbers = [v.number for v in live_versions(spark, root, "lengths/_SUCCESS")[1]]
    update_index(spark, first, root, batch="7")  # a replay, after a later batch
    found(*want)
    update_index(spark, late, root, batch="9")
    found(*want)
    deltas = live_versions(spark, root, "lengths/_SUCCESS")[1]
    assert [v.batch for v in deltas] == ["8", "7", "9"] and len(numbers) == 2
    assert len([v for v in versions(spark, root) if v.kind == "delta"]) == 0  # marked in lengths
    compact_index(spark, root)
    found(*want)


def test_postings_and_statistics(documents):
    fields = {"content": STANDARD, "tags": STANDARD}
    postings = build_postings(documents, fields)
    rows = {(r.field, r.term, r.id): (r.tf, r.len) for r in postings.collect()}
    assert rows[("content", "people", "c")] == (3, 8)
    assert rows[("tags", "list", "c")] == (1, 3)
    assert not [k for k in rows if k[2] == "d"]
    df = {(r.field, r.term): r.df for r in term_stats(postings).collect()}
    assert df[("content", "the")] == 4 and df[("tags", "people")] == 1
    stats = {r.field: (r.doc_count, r.avg_len) for r in field_stats(documents, fields).collect()}
    assert stats["tags"] == (2, 2.5) and stats["content"][0] == 4


def test_present_fields(documents):
    assert present_fields(documents) == FIELDS
    assert present_fields(documents.select("id", "title")) == {"title": STANDARD}


def test_other_id_columns(documents):
    renamed = documents.withColumnRenamed("id", "key").withColumn("key", F.upper("key"))
    assert pairs(search(renamed, "settings", 5, id_col="key"))[0][0] == "B"


def test_pairs_of_query_and_document_are_not_shuffled(documents, queries):
    index = build_index(documents, {"content": STANDARD})
    scored = bm25.score_many(index, queries)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" in plan and "hashpartitioning(query_id" not in plan
    single = bm25.score_many(index, queries, bounded=True)
    assert sorted(scored.collect()) == sorted(single.collect())
