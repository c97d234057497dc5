import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import vectors
from corpusloom.operators.analysis import STANDARD, build_index
from corpusloom.operators.hybrid import fuse_ranks, hybrid_search, hybrid_search_many
from corpusloom.operators.bm25 import search
from corpusloom.operators.vectors import (
    build_vector_index,
    knn,
    knn_approx,
    knn_many,
    open_vector_index,
    write_vector_index,
)

N, DIMS = 400, 12


@pytest.fixture(scope="module")
def matrix():
    return np.random.default_rng(3).normal(size=(N, DIMS)).astype(np.float32)


@pytest.fixture(scope="module")
def documents(spark, matrix):
    rows = [(f"d{n:03}", [float(x) for x in matrix[n]], f"word{n % 7} common text {n}") for n in range(N)]
    rows += [("copy", rows[5][1], "copy"), ("none", None, "word1"), ("zero", [0.0] * DIMS, "zero"),
             ("short", [1.0, 2.0], "short")]
    schema = "id string, embedding array<float>, content string"
    return spark.createDataFrame(rows, schema).repartition(5).cache()


def brute_force(matrix, vector, limit):
    ids = [f"d{n:03}" for n in range(N)] + ["copy"]
    all_rows = np.vstack([matrix, matrix[5]]).astype(np.float64)
    v = np.asarray(vector, dtype=np.float64)
    scores = np.round(all_rows @ v / np.linalg.norm(all_rows, axis=1) / np.linalg.norm(v), 9)
    return sorted(zip(ids, scores), key=lambda x: (-x[1], x[0]))[:limit]


def found(hits):
    return [(r["id"], r["score"]) for r in sorted(hits.collect(), key=lambda r: r["rank"])]


@pytest.mark.parametrize("limit", [1, 10, N + 50])
def test_exact(documents, matrix, limit):
    vector = [float(x) for x in matrix[5]]
    got = found(knn(documents, vector, limit))
    want = brute_force(matrix, vector, limit)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want])
    if limit > 1:
        assert [i for i, _ in got[:2]] == ["copy", "d005"]


def test_limits(documents, matrix):
    assert knn(documents, matrix[0].tolist(), 0).count() == 0
    with pytest.raises(ValueError):
        knn(documents, matrix[0].tolist(), -2)


@pytest.fixture(scope="module")
def queries(spark):
    vectors_ = np.random.default_rng(9).normal(size=(9, DIMS)).astype(np.float32)
    rows = [(n, [float(x) for x in v], f"word{n % 7} text") for n, v in enumerate(vectors_)]
    rows.append((99, None, "word3"))
    return spark.createDataFrame(rows, "query_id int, query_embedding array<float>, query string")


def check_many(hits, queries, matrix, limit):
    rows = hits.collect()
    for query in queries.where("query_embedding is not null").collect():
        mine = sorted((r for r in rows if r["query_id"] == query["query_id"]), key=lambda r: r["rank"])
        want = brute_force(matrix, query["query_embedding"], limit)
        assert [r["id"] for r in mine] == [i for i, _ in want]
    assert not [r for r in rows if r["query_id"] == 99]


def test_many(documents, queries, matrix):
    check_many(knn_many(documents, queries, 6), queries, matrix, 6)


def test_many_in_blocks(documents, queries, matrix, monkeypatch):
    """Blocks of queries and small score buffers change nothing."""
    monkeypatch.setattr(vectors, "QUERIES_PER_BLOCK", 2)
    monkeypatch.setattr(vectors, "SCORE_BYTES", 200)
    check_many(knn_many(documents, queries, 6), queries, matrix, 6)


def test_many_refuses_mixed_sizes(spark, documents):
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "query_id int, query_embedding array<float>")
    with pytest.raises(ValueError):
        knn_many(documents, mixed)


def test_no_cross_join(documents, queries, capsys):
    knn_many(documents, queries, 3).explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_approximate_recall(spark, documents, matrix, tmp_path):
    hits = 0
    write_vector_index(build_vector_index(documents, matrix.shape[1], 16), str(tmp_path))
    index = open_vector_index(spark, str(tmp_path))
    for n in range(0, 50, 5):
        vector = matrix[n].tolist()
        exact = {i for i, _ in brute_force(matrix, vector, 10)}
        hits += len(exact & {i for i, _ in found(knn_approx(index, vector, 10, n_probe=8))})
    assert hits / 100 >= 0.8
    # Few cells hold less than is asked for: more are read.
    everything = documents.where("embedding is not null").count()
    assert len(found(knn_approx(index, matrix[0].tolist(), 10_000, n_probe=1))) == len(
        found(knn(documents, matrix[0].tolist(), 10_000))
    ) <= everything


def test_fusion_does_not_depend_on_the_order_of_arms(spark):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "id string, rank int")
    two = spark.createDataFrame([("b", 1), ("c", 2)], "id string, rank int")
    forward = sorted(fuse_ranks([one, two], ["id"]).collect())
    assert forward == sorted(fuse_ranks([two, one], ["id"]).collect())
    assert dict(forward)["b"] == pytest.approx(1 / 61 + 1 / 62, abs=1e-8)


def test_hybrid(documents, matrix):
    fields = {"content": STANDARD}
    vector = matrix[8].tolist()
    text = [r["id"] for r in sorted(search(documents, "word1 text", 20, fields).collect(), key=lambda r: r["rank"])]
    near = [i for i, _ in found(knn(documents, vector, 20))]
    scores = {}
    for arm in (text, near):
        for rank, name in enumerate(arm, 1):
            scores[name] = scores.get(name, 0) + 1 / (60 + rank)
    want = sorted(((i, round(s, 9)) for i, s in scores.items()), key=lambda x: (-x[1], x[0]))[:20]
    got = found(hybrid_search(documents, "word1 text", vector, 20, fields))
    assert [i for i, _ in got] == [i for i, _ in want]
    assert set(text) & set(near), "some document must be found by both arms"


def test_hybrid_without_a_vector_is_text_search(documents):
    fields = {"content": STANDARD}
    assert found(hybrid_search(documents, "word1", None, 5, fields)) == found(
        search(documents, "word1", 5, fields)
    )


def test_hybrid_many_equals_single(documents, queries):
    fields = {"content": STANDARD}
    index = build_index(documents, fields)
    rows = hybrid_search_many(index, documents, queries, 8).collect()
    for query in queries.where("query_id in (0, 1, 99)").collect():
        mine = sorted((r for r in rows if r["query_id"] == query["query_id"]), key=lambda r: r["rank"])
        single = hybrid_search(documents, query["query"], query["query_embedding"], 8, fields)
        assert [r["id"] for r in mine] == [i for i, _ in found(single)]


def test_documents_come_with_the_hits(documents, matrix):
    hits = hybrid_search(documents, "word2", matrix[2].tolist(), 3, {"content": STANDARD})
    assert hits.where(F.col("content").isNull()).count() == 0
    assert set(hits.columns) == {"id", "score", "rank", "embedding", "content"}
