"""Table schemas shared by the sources, operators and sinks."""

from pyspark.sql import types as T

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("summary", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

# One scrape writes one manifest. A scrape too large for one JSON row is split
# into `parts` rows that share `scrape_prefix`; `page_count` is the scrape's
# total and `pages` the slice held by this part. Manifests without the last
# three fields are single-part and take their prefix from the file path.
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("source_url", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("page_count", T.LongType()),
        T.StructField("pages", T.ArrayType(T.StringType())),
        T.StructField("scrape_prefix", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("parts", T.IntegerType()),
    ]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
    ]
)

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)

QUERY_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("query_embedding", T.ArrayType(T.FloatType())),
    ]
)
