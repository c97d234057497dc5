"""From documents to token ids: five stages, each written as Parquet and read again.

A stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All
but the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from pathlib import Path
import sys

sys.path.insert(0, str(Path(__file__).parent))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from corpusloom.llm.byte_bpe import decode_documents, encode_documents  # noqa: E402
from corpusloom.llm.common import WORD, free_names, work_table  # noqa: E402
from corpusloom.llm.decontamination import contaminated  # noqa: E402
from corpusloom.llm.jaccard_join import similar_documents  # noqa: E402
from corpusloom.llm.line_dedup import dedup_lines  # noqa: E402
from corpusloom.llm.quality_rules import quality_rules  # noqa: E402
from corpusloom.plans import broadcast_if_bounded  # noqa: E402
from corpusloom.session import ship_package  # noqa: E402


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` with the text replaced by ``clean_text``."""
    text = F.col("clean_text")
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return docs.select(*[changed.get(name, F.col(name)).alias(name) for name in columns])


def filter_by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without boilerplate lines."""
    ship_package(spark)
    return _with_text(quality_rules(docs).where("kept"), docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier, in the same or similar words.

    A document that lost lines and has no word left goes.
    """
    ship_package(spark)
    left = F.col("clean_text").rlike(WORD)
    found = dedup_lines(docs)
    return _with_text(found.where((F.col("n_removed_lines") == 0) | left), docs.columns)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells documents apart: a hash of id and text.

    Rows of one id and text are one document; rows of one id and other texts, and rows
    without an id, are documents of their own.
    """
    (key,) = free_names(docs, 1)
    return docs.withColumn(key, F.xxhash64("doc_id", "text")), key


def drop_similar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones: that with the smallest id.

    A null id comes after all others. Of a document that is there in several rows, one stays.
    """
    ship_package(spark)
    keyed, key = _keyed(docs)
    similar = similar_documents(keyed.select(F.col(key).alias("doc_id"), "text"))
    ids = keyed.groupBy(F.col(key).alias("key")).agg(
        F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n")
    )
    members = similar.select(F.col("doc_id").alias("key"), "component_id").distinct()
    members = work_table(members.join(ids, "key"))
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "key")
    best = members.groupBy("component_id").agg(F.min(order).alias("best"))
    chosen = best.select(F.col("best.key").alias("key"))
    gone = work_table(members.join(chosen, "key", "left_anti").select(F.col("key").alias(key)))
    repeated = work_table(
        members.where("n > 1").join(chosen, "key", "left_semi").select(F.col("key").alias(key))
    )
    left_out, _ = broadcast_if_bounded(gone.union(repeated))
    several, _ = broadcast_if_bounded(repeated)
    single = keyed.join(left_out, key, "left_anti").select(*docs.columns)
    # A row of each is kept in every task, before the shuffle.
    row = F.min(F.struct(*docs.columns)).alias("row")
    again = keyed.join(several, key, "left_semi").groupBy(key).agg(row).select("row.*")
    return single.unionByName(again)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed, key = _keyed(docs)
    pairs = contaminated(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark)
    leaks = work_table(pairs.select(F.col("doc_id").alias(key)).distinct())
    found, _ = broadcast_if_bounded(leaks)
    return keyed.join(found, key, "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with digests of them and of their decoded bytes."""
    ship_package(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    columns = docs.select("doc_id", "text")
    encoded = encode_documents(columns, ranks, public_tokenizers.PATTERN)
    return decode_documents(encoded, ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", filter_by_quality),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_similar_documents),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: Not expressible in SQL: MinHash signatures and byte pair merges. The tests compare
#: with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = work_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
