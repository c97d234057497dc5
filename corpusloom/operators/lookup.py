"""Lookup by id."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import broadcast_if_bounded


def get_document(documents: DataFrame, doc_id: str, id_col: str = "id") -> DataFrame:
    """The document with this id, or no row. The equality reaches the Parquet scan."""
    return documents.where(F.col(id_col) == doc_id).limit(1)


def get_many(documents: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """One row per requested id: a ``found`` flag and the document, if any.

    ``ids`` has a column ``id``. The documents are first reduced to the requested
    ids, by broadcast when their measured size allows.
    """
    wanted = ids.select("id").distinct()
    rows = documents if id_col == "id" else documents.withColumnRenamed(id_col, "id")
    small, _ = broadcast_if_bounded(wanted)
    matched = rows.join(small, "id", "left_semi").withColumn("found", F.lit(True))
    return wanted.join(matched, "id", "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )
