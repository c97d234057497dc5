"""Recall of the approximate search with its defaults."""

import pytest

from corpusloom.operators.vectors import (
    build_vector_index,
    knn_approx,
    knn_many,
    open_vector_index,
    write_vector_index,
)
from pyspark.sql import functions as F


@pytest.mark.parametrize("limit", [10, 50])
def test_recall_of_every_hundredth_vector(spark, tmp_path, limit):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    asked = vectors.where("vec_id % 100 = 0").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding")
    )
    write_vector_index(build_vector_index(vectors, 64, id_col="vec_id"), str(tmp_path))
    index = open_vector_index(spark, str(tmp_path))
    true = {}
    for row in knn_many(vectors, asked, limit, id_col="vec_id").collect():
        true.setdefault(row["query_id"], set()).add(row["id"])
    assert len(true) >= 20
    for row in asked.collect():
        found = knn_approx(index, row["query_embedding"], limit).collect()
        hits = {hit["id"] for hit in found} & true[row["query_id"]]
        assert len(found) == limit and len(hits) >= 0.9 * limit
