"""The registered queries of this subpackage and their SQL."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .byte_bpe import decode_documents, encode_documents
from .chat import format_conversations, read_back
from .common import work_path
from .decontamination import contaminated
from .hard_negatives import hard_negatives
from .jaccard_join import similar_documents
from .kd_search import top_k
from .line_dedup import dedup_lines
from .merkle import folded_root, group_key, leaf_digest, merkle_manifest
from .quality_classifier import score_documents, train, training_examples
from .quality_rules import quality_rules
from .repeated_strings import remove_repeated
from .token_files import read_token_files, write_token_files
from .warc import read_warc, write_warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_documents(docs, ranks, public_tokenizers.PATTERN)
    decoded = decode_documents(encoded, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(manifest).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@query(
    sql="""
    WITH p AS (
        SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
    ), d AS (
        SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest
        FROM p
    ), w AS (
        SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS latest FROM d
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND page_id < latest THEN 'revisit' ELSE 'response' END
            AS record_type,
        CASE WHEN payload_bytes >= 1000 AND page_id < latest THEN latest END AS refers_to
    FROM w
    """
)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_path(spark)
    manifest = write_warc(table(spark, sf_dir, "pages"), path=root)
    records = read_warc(spark, root, manifest)
    # The digest of a response is taken from the bytes that were read.
    digest = F.when(F.col("record_type") == "response", F.sha1("payload"))
    size = F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long"))
    return records.where("gap is null").select(
        "page_id",
        F.coalesce(size, "payload_bytes").alias("payload_bytes"),
        F.coalesce(digest, "payload_digest").alias("payload_digest"),
        "record_type",
        F.regexp_extract("refers_to", r"<urn:page:(-?\d+)>", 1).try_cast("long").alias("refers_to"),
    )


@query(
    sql=r"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ), marked AS (
        SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')
            AS body
        FROM rows
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
        CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT)
            AS loss_chars,
        sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn),
            '')) AS loss_sha256,
        CAST(sum(length('### ' || role || ': ' || body || ' </turn>' || chr(10))) AS BIGINT)
            AS formatted_chars,
        regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u'
            WHEN 'assistant' THEN 'a' ELSE 'x' END, '' ORDER BY turn), 's?u(au)*a?') AS valid
    FROM marked GROUP BY conv_id
    """
)
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return read_back(format_conversations(rows.union(more)))


_LINE = (
    "regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'),"
    " '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')"
)


@query(
    sql=rf"""
    WITH d AS (
        SELECT doc_id, source, coalesce(text, '') AS text,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents
    ), windows AS (
        SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)
    ), repeated AS (
        SELECT doc_id, i FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows
        ) WHERE n > 1
    ), covered AS (
        SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
        FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
    ), lines AS (
        SELECT doc_id, source, text, line, {_LINE} AS plain,
            len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
        FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d)
    ), worded AS (
        SELECT * FROM lines WHERE n > 0
    ), duplicates AS (
        SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id
    ), hosts AS (
        SELECT source, count(DISTINCT text) AS total FROM documents
        WHERE text IS NOT NULL GROUP BY source
    ), frequent AS (
        SELECT w.source, plain FROM worded w JOIN hosts h
            ON w.source IS NOT DISTINCT FROM h.source
        GROUP BY w.source, plain, total
        HAVING count(DISTINCT text) >= 20 AND count(DISTINCT text) * 100 > total
    ), removed AS (
        SELECT doc_id, count(*) AS n_removed_lines, sum(n) AS removed_words
        FROM worded w JOIN frequent f
            ON w.source IS NOT DISTINCT FROM f.source AND w.plain = f.plain
        GROUP BY doc_id
    ), s AS (
        SELECT doc_id, len(words) AS n_words,
            CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT)
                AS word_chars,
            CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
            coalesce(n_dup_lines, 0) AS n_dup_lines,
            coalesce(n_repeat_words, 0) AS n_repeat_words,
            coalesce(n_removed_lines, 0) AS n_removed_lines,
            CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN duplicates USING (doc_id)
            LEFT JOIN removed USING (doc_id)
    ), b AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s
    )
    SELECT *, NOT base_failed AND NOT removed_words * 100 > n_words * 80 AS kept FROM b
    """
)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_removed_lines",
        "removed_words",
        "base_failed",
        "kept",
    )


@query()
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = train(training_examples(docs, labels.where(remainder != 1)))
    return score_documents(docs, model).select(
        "doc_id",
        (remainder == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, table(spark, sf_dir, "benchmark"))


@query()
def op3_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query()
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed_lines", "removed_chars")


def _integer_rows(factor: int) -> str:
    """SQL of ``id, label, v``: the rows that take part, their components whole numbers."""
    return f"""
        SELECT vec_id AS id, label,
            [floor({factor} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
        FROM embeddings
        WHERE embedding IS NOT NULL
            AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    """


@query(
    sql=f"""
    WITH e AS (
        SELECT id, v, CASE WHEN id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
        FROM ({_integer_rows(256)}) WHERE label IS NOT NULL
    ), scored AS (
        SELECT a.id AS anchor_id, e.id, a.label = e.label AS same,
            CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
        FROM e a, e WHERE a.id % 100 = 0 AND a.id <> e.id
    ), positives AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM (
            SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS n
            FROM scored WHERE same
        ) WHERE n <= 5
    ), found AS (
        SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
            CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
                AS INTEGER) AS rank
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    )
    SELECT * FROM found WHERE rank <= 10
    """
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(
        table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label, factor=256
    )


#: SQL: whether 2 divides the crc32 of the decimal doc_id, bit by bit.
_EVEN_CRC = """
    (list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten([
        [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]
        FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
        lambda crc, b: CASE WHEN xor(crc, b) & 1 = 1 THEN xor(xor(crc, b) >> 1, 3988292384)
            ELSE xor(crc, b) >> 1 END) & 1 = 1)
"""


def _sized(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


_HEAD = " || ".join(_sized(name) for name in ("doc_id", "source", "lang", "n_chars"))


@query(
    sql=rf"""
    WITH RECURSIVE d AS (
        SELECT *, CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS changed
        FROM (SELECT *, {_EVEN_CRC} AS even FROM documents)
    ), leaves AS (
        SELECT doc_id, source, sha256({_HEAD} || {_sized("text")}) AS leaf,
            CASE WHEN even THEN sha256({_HEAD} || {_sized("changed")}) END AS tampered
        FROM d
    ), lower_levels AS (
        SELECT source, 0 AS level, doc_id,
            row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY source) AS n, leaf AS digest
        FROM leaves
        UNION ALL
        SELECT source, level + 1, NULL, pos // 3, (n + 2) // 3,
            sha256(string_agg(digest, '' ORDER BY pos))
        FROM lower_levels WHERE n > 1 GROUP BY source, level, pos // 3, n
    ), subroots AS (
        SELECT source, digest AS subroot FROM lower_levels WHERE n = 1
    ), upper_levels AS (
        SELECT 0 AS level, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos,
            count(*) OVER () AS n, subroot AS digest, source
        FROM subroots
        UNION ALL
        SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)), NULL
        FROM upper_levels WHERE n > 1 GROUP BY level, pos // 3, n
    ), root AS (
        SELECT digest AS root FROM upper_levels WHERE n = 1
    ), lower_fold AS (
        SELECT t.doc_id, t.source, 0 AS level, l.pos, l.n,
            coalesce(tampered, leaf) AS digest, '' AS proof, leaf
        FROM leaves t
            JOIN lower_levels l ON l.level = 0 AND l.doc_id = t.doc_id
        UNION ALL
        SELECT f.doc_id, f.source, f.level + 1, f.pos // 3, (f.n + 2) // 3,
            sha256(string_agg(CASE WHEN l.pos = f.pos THEN f.digest ELSE l.digest END, ''
                ORDER BY l.pos)),
            f.proof || coalesce(string_agg(CASE WHEN l.pos <> f.pos THEN l.digest END, ''
                ORDER BY l.pos), ''),
            f.leaf
        FROM lower_fold f JOIN lower_levels l ON l.source IS NOT DISTINCT FROM f.source
            AND l.level = f.level AND l.pos // 3 = f.pos // 3
        WHERE f.n > 1 GROUP BY f.doc_id, f.source, f.level, f.pos, f.n, f.proof, f.leaf
    ), upper_fold AS (
        SELECT f.doc_id, 0 AS level, u.pos, u.n, f.digest, f.proof, f.leaf, u.digest AS subroot
        FROM lower_fold f JOIN upper_levels u
            ON u.level = 0 AND u.source IS NOT DISTINCT FROM f.source
        WHERE f.n = 1
        UNION ALL
        SELECT f.doc_id, f.level + 1, f.pos // 3, (f.n + 2) // 3,
            sha256(string_agg(CASE WHEN u.pos = f.pos THEN f.digest ELSE u.digest END, ''
                ORDER BY u.pos)),
            f.proof || coalesce(string_agg(CASE WHEN u.pos <> f.pos THEN u.digest END, ''
                ORDER BY u.pos), ''),
            f.leaf, f.subroot
        FROM upper_fold f JOIN upper_levels u ON u.level = f.level AND u.pos // 3 = f.pos // 3
        WHERE f.n > 1 GROUP BY f.doc_id, f.level, f.pos, f.n, f.proof, f.leaf, f.subroot
    )
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, digest AS folded_root,
        digest = root AS verified
    FROM upper_fold, root WHERE n = 1
    """
)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars"]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    leaves = docs.select(
        group_key("source").alias("group"),
        F.col("doc_id").cast("long").alias("id"),
        leaf_digest([*columns, "text"]).alias("leaf"),
        F.when(tampered, leaf_digest([*columns, F.replace("text", F.lit("\n"), F.lit(""))])).alias("tampered"),
    )
    manifest = folded_root(
        merkle_manifest(leaves).withColumn("tried", F.coalesce("tampered", "leaf")), "tried", "folded"
    )
    text = lambda name: F.lower(F.hex(name))
    return manifest.select(
        F.col("id").alias("doc_id"),
        *(text(name).alias(name) for name in ("leaf", "subroot", "root")),
        F.sha2(text("siblings"), 256).alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


@query(
    sql=f"""
    WITH e AS (SELECT id, v FROM ({_integer_rows(64)}))
    SELECT * FROM (
        SELECT q.id AS query_id, e.id AS vec_id,
            CAST(list_dot_product(q.v, e.v) AS BIGINT) AS score,
            CAST(row_number() OVER (
                PARTITION BY q.id ORDER BY list_dot_product(q.v, e.v) DESC, e.id) AS INTEGER) AS rank
        FROM e q, e WHERE q.id % 20 = 0 AND q.id <> e.id
    ) WHERE rank <= 20
    """
)
def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20, factor=64)
    return found.withColumnRenamed("id", "vec_id")
