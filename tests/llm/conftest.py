import pytest

DOC_SCHEMA = "doc_id long, text string, source string"


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) pairs, in a few partitions, with clashing columns.

    The extra columns have names that operators use for their own results.
    """

    def make(rows, parts=3):
        rows = [(k, t, "host", -1, "x", -1) for k, t in rows]
        schema = "doc_id long, text string, source string, n_words int, kept string, n_spans int"
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


@pytest.fixture
def collect():
    def rows(df, key="doc_id"):
        found = [tuple(row) for row in df.collect()]
        at = df.columns.index(key)
        return sorted(found, key=lambda row: (row[at] is not None, row[at] or 0, str(row)))

    return rows
