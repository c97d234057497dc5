"""Queries over the column functions and the text analysis."""

from pyspark.sql import functions as F

from .. import functions as fn
from ..functions.models import MODEL_INPUT_BYTES
from ..functions.pages import TITLE_ENTITIES
from ..operators.analysis import STANDARD, build_postings, field_stats
from ..operators.enrich import lead_summary, tfidf_tags
from ..sources import select_sources
from . import registry as r
from .registry import documents_table, pages_table, query, table


@query(f"SELECT page_id, {r.document_id('url')} AS id FROM pages")
def document_id(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", fn.document_id("url").alias("id"))


@query(
    f"""
    WITH p AS (
        SELECT page_id, url, {r.host('url')} AS host,
               strftime(to_timestamp(1700000000 + page_id) AT TIME ZONE 'UTC', '%Y-%m-%dT%H-%M-%S')
               || '-' || substr(sha256(url || '-' || (1700000000 + page_id) || '000000000'), 1, 8)
               AS run
        FROM pages
    )
    SELECT page_id, host,
           'scrapes/' || host || '/' || run AS prefix,
           'scrapes/' || host || '/' || run || '/pages/' || {r.document_id('url')} || '.md' AS page_key,
           'scrapes/' || host || '/' || run || '/metadata.json' AS manifest_key,
           {r.document_id('url')} || '.md' AS file_name
    FROM p
    """
)
def object_keys(spark, sf_dir):
    prefix = fn.scrape_prefix("url", "scraped_at")
    key = fn.object_key(prefix, fn.document_id("url"))
    return pages_table(spark, sf_dir).select(
        "page_id",
        fn.url_host("url").alias("host"),
        prefix.alias("prefix"),
        key.alias("page_key"),
        fn.manifest_key(prefix).alias("manifest_key"),
        fn.object_name(key).alias("file_name"),
    )


_DETECT_ROWS = """
    SELECT 'page ' || page_id AS name, url, 'text/html; charset=utf-8' AS content_type, html AS content
    FROM pages
    UNION ALL
    SELECT 'page as markdown ' || page_id, url, 'Text/Markdown; charset=utf-8', html FROM pages
    UNION ALL
    SELECT 'page as file ' || page_id, url || '.MD', '', html FROM pages
    UNION ALL
    SELECT 'plain ' || doc_id, 'https://docs.example.org/' || doc_id, '', text FROM documents
    UNION ALL
    SELECT 'heading ' || doc_id, 'https://docs.example.org/' || doc_id, '', chr(10) || ' ## ' || text
    FROM documents
    UNION ALL
    SELECT 'list ' || doc_id, 'https://docs.example.org/' || doc_id, 'text/plain',
           text || chr(10) || '* ' || doc_id
    FROM documents
    UNION ALL
    SELECT 'link ' || doc_id, 'https://docs.example.org/' || doc_id, '', text || ' [see](#' || doc_id || ')'
    FROM documents
    UNION ALL
    SELECT 'carriage return ' || doc_id, 'https://docs.example.org/' || doc_id, '',
           text || chr(13) || '- ' || doc_id || ' [a' || chr(13) || 'b](c)'
    FROM documents
"""


@query(
    f"""
    WITH rows AS ({_DETECT_ROWS}),
    trimmed AS (SELECT *, {r.trim('content')} AS text FROM rows),
    flags AS (
        SELECT name, url, content_type, text,
               starts_with(lower(content_type), 'text/markdown')
                   OR starts_with(lower(content_type), 'text/x-markdown') AS by_type,
               lower(url) LIKE '%.md' OR lower(url) LIKE '%.markdown' AS by_url,
               regexp_matches(lower(text), '^(<!doctype|<html|<head|<body)') AS is_html,
               regexp_matches(text, '^#{{1,6}}[\\t\\n\\f\\r ]+[^\\t\\n\\f\\r ]')
                   OR regexp_matches(text, '(?m)^[-*][\\t\\n\\f\\r ]+[^\\t\\n\\f\\r ]')
                   OR regexp_matches(text, '\\[[^\\n]+?\\]\\([^\\n]+?\\)') AS has_patterns
        FROM trimmed
    )
    SELECT name, by_type, by_url, is_html, has_patterns,
           text <> '' AND NOT is_html AND has_patterns AS by_content,
           by_type OR by_url OR (text <> '' AND NOT is_html AND has_patterns) AS is_markdown
    FROM flags
    """
)
def markdown_detect(spark, sf_dir):
    pages = pages_table(spark, sf_dir).select("page_id", "url", F.col("body").alias("content"))
    texts = documents_table(spark, sf_dir).select("id", "content")

    def page_rows(label, url, content_type):
        return pages.select(
            F.concat(F.lit(label + " "), "page_id").alias("name"),
            url.alias("url"),
            F.lit(content_type).alias("content_type"),
            "content",
        )

    def text_rows(label, content, content_type=""):
        return texts.select(
            F.concat(F.lit(label + " "), "id").alias("name"),
            F.concat(F.lit("https://docs.example.org/"), "id").alias("url"),
            F.lit(content_type).alias("content_type"),
            content.alias("content"),
        )

    text, doc = F.col("content"), F.col("id")
    rows = (
        page_rows("page", F.col("url"), "text/html; charset=utf-8")
        .unionByName(page_rows("page as markdown", F.col("url"), "Text/Markdown; charset=utf-8"))
        .unionByName(page_rows("page as file", F.concat("url", F.lit(".MD")), ""))
        .unionByName(text_rows("plain", text))
        .unionByName(text_rows("heading", F.concat(F.lit("\n ## "), text)))
        .unionByName(text_rows("list", F.concat(text, F.lit("\n* "), doc), "text/plain"))
        .unionByName(text_rows("link", F.concat(text, F.lit(" [see](#"), doc, F.lit(")"))))
        .unionByName(
            text_rows("carriage return", F.concat(text, F.lit("\r- "), doc, F.lit(" [a\rb](c)")))
        )
    )
    trimmed = fn.trim_ws("content")
    return rows.select(
        "name",
        fn.is_markdown_content_type("content_type").alias("by_type"),
        fn.is_markdown_url("url").alias("by_url"),
        fn.looks_like_html(trimmed).alias("is_html"),
        fn.has_markdown_patterns(trimmed).alias("has_patterns"),
        fn.is_markdown_content("content").alias("by_content"),
        fn.detect_markdown("url", "content_type", "content").alias("is_markdown"),
    )


_VARIANT_ROWS = """
    SELECT url FROM pages
    UNION ALL SELECT url || '/' FROM pages
    UNION ALL SELECT url || '/README.MD' FROM pages
    UNION ALL SELECT 'https://github.com/a/b' || page_id || '/blob/main/github.com/blob/x.md' FROM pages
    UNION ALL SELECT 'https://github.com/a/b' || page_id || '/tree/main' FROM pages
"""


@query(
    f"""
    SELECT url,
           CASE WHEN contains(url, 'github.com') AND contains(url, '/blob/')
                THEN regexp_replace(regexp_replace(url, 'github\\.com', 'raw.githubusercontent.com'),
                                    '/blob/', '/')
                WHEN lower(url) LIKE '%.md' OR lower(url) LIKE '%.markdown' THEN ''
                ELSE regexp_replace(url, '/$', '') || '.md' END AS variants
    FROM ({_VARIANT_ROWS})
    """
)
def markdown_url_variants(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    code = F.concat(F.lit("https://github.com/a/b"), "page_id")
    urls = [
        F.col("url"),
        F.concat("url", F.lit("/")),
        F.concat("url", F.lit("/README.MD")),
        F.concat(code, F.lit("/blob/main/github.com/blob/x.md")),
        F.concat(code, F.lit("/tree/main")),
    ]
    exploded = pages.select(F.explode(F.array(*urls)).alias("url"))
    return exploded.select(
        "url", F.array_join(fn.markdown_url_variants("url"), " ").alias("variants")
    )


def sql_html_title(html: str) -> str:
    title = (
        f"coalesce(list_extract(regexp_extract_all({html}, "
        "'(?is)<title(?:[\\s/][^>]*)?>([^<]+)</title', 1), -1), '')"
    )
    for entity, text in TITLE_ENTITIES.items():
        shown = text.replace("'", "''")
        title = f"regexp_replace({title}, '{entity}', '{shown}', 'g')"
    return r.trim(title)


@query(
    f"""
    SELECT page_id, {sql_html_title('html')} AS title,
           coalesce(nullif({sql_html_title('html')}, ''), url) AS title_or_url,
           {sql_html_title("replace(html, '</title>', ' &amp;lt; &middot;</title><title>Last ' || page_id || '</title>')")}
               AS last_title,
           coalesce(nullif({sql_html_title("replace(html, 'title>', 'name>')")}, ''), url) AS no_title
    FROM pages
    """
)
def html_title(spark, sf_dir):
    html = F.col("body")
    last = F.concat(
        F.lit(" &amp;lt; &middot;</title><title>Last "), "page_id", F.lit("</title>")
    )
    twice = F.replace(html, F.lit("</title>"), last)
    without = F.replace(html, F.lit("title>"), F.lit("name>"))
    return pages_table(spark, sf_dir).select(
        "page_id",
        fn.html_title(html).alias("title"),
        fn.title_or_url(fn.html_title(html), "url").alias("title_or_url"),
        fn.html_title(twice).alias("last_title"),
        fn.title_or_url(fn.html_title(without), "url").alias("no_title"),
    )


@query(
    f"""
    WITH made AS (
        SELECT doc_id,
               CASE doc_id % 3
                    WHEN 0 THEN '# First ' || doc_id || ' #' || chr(10) || text
                    WHEN 1 THEN text || chr(10) || '## Minor' || chr(10) || chr(9) || ' # Deep ' || doc_id
                         || chr(13) || chr(10) || '# Second'
                    ELSE text END AS content
        FROM documents
    ),
    titled AS (
        SELECT doc_id,
               coalesce(substr(list_extract(list_filter(
                   list_transform(string_split(content, chr(10)), lambda x: {r.trim('x')}),
                   lambda x: starts_with(x, '# ')), 1), 3), '') AS title
        FROM made
    )
    SELECT doc_id AS id, title,
           coalesce(nullif(title, ''), 'https://docs.example.org/' || doc_id) AS title_or_url
    FROM titled
    """
)
def markdown_title(spark, sf_dir):
    doc, text = F.col("id"), F.col("content")
    content = (
        F.when(doc % 3 == 0, F.concat(F.lit("# First "), doc, F.lit(" #\n"), text))
        .when(
            doc % 3 == 1,
            F.concat(text, F.lit("\n## Minor\n\t # Deep "), doc, F.lit("\r\n# Second")),
        )
        .otherwise(text)
    )
    url = F.concat(F.lit("https://docs.example.org/"), "id")
    titled = documents_table(spark, sf_dir).select(
        "id", fn.markdown_title(content).alias("title"), url.alias("url")
    )
    return titled.select("id", "title", fn.title_or_url("title", "url").alias("title_or_url"))


def _sql_cut(limit: int) -> str:
    """Hex of the first bytes, a cut character replaced by U+FFFD."""
    head = f"substr(hex(encode(text)), 1, {2 * limit})"
    partial = "(C[2-9A-F]|D[0-9A-F]|E[0-9A-F]([89AB][0-9A-F])?|F[0-4]([89AB][0-9A-F]){0,2})$"
    fixed = (
        f"CASE WHEN regexp_matches({head}, '{partial}') "
        f"THEN regexp_replace({head}, '{partial}', 'EFBFBD') ELSE {head} END"
    )
    return f"CASE WHEN strlen(text) > {limit} THEN {fixed} ELSE hex(encode(text)) END"


@query(
    f"""
    SELECT doc_id AS id,
           md5({_sql_cut(500)}) AS cut_500,
           md5({_sql_cut(20000)}) AS cut_20000,
           strlen({_sql_cut(20000)}) // 2 AS bytes_20000
    FROM documents
    """
)
def truncate_bytes(spark, sf_dir):
    short = F.hex(fn.truncate_bytes("content", 500).cast("binary"))
    long = F.hex(fn.truncate_bytes("content", 20000).cast("binary"))
    return documents_table(spark, sf_dir).select(
        "id",
        F.md5(short).alias("cut_500"),
        F.md5(long).alias("cut_20000"),
        F.octet_length(fn.truncate_bytes("content", 20000)).cast("bigint").alias("bytes_20000"),
    )


@query(
    f"""
    WITH t AS (
        SELECT doc_id,
               list_filter(list_transform(string_split(text || ' ,, ' || text, ','), lambda x: {r.trim('x')}),
                           lambda x: x <> '') AS tags
        FROM documents
    )
    SELECT doc_id AS id, len(tags) AS n_tags, md5(array_to_string(tags, '|')) AS tags FROM t
    """
)
def parse_tags(spark, sf_dir):
    answer = F.concat("content", F.lit(" ,, "), "content")
    parsed = documents_table(spark, sf_dir).select("id", fn.parse_tags(answer).alias("tags"))
    return parsed.select(
        "id",
        F.size("tags").cast("bigint").alias("n_tags"),
        F.md5(F.array_join("tags", "|")).alias("tags"),
    )


@query(
    """
    SELECT source AS name, 'https://docs.example.org/' || doc_id AS url
    FROM documents WHERE source = 'src7' AND lang <> 'de'
    """,
    name="select_sources",
)
def select_named_source(spark, sf_dir):
    return select_sources(_sources(spark, sf_dir), name="src7")


@query(
    """
    SELECT source AS name, 'https://docs.example.org/' || doc_id AS url
    FROM documents WHERE lang <> 'de'
    """
)
def select_all_sources(spark, sf_dir):
    return select_sources(_sources(spark, sf_dir))


def _sources(spark, sf_dir):
    url = F.concat(F.lit("https://docs.example.org/"), "doc_id")
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("name"),
        F.when(F.col("lang") == "de", F.lit("")).otherwise(url).alias("url"),
    )


@query(
    """
    SELECT item_id, CASE item_id % 4 WHEN 0 THEN 768 WHEN 1 THEN 1024 WHEN 2 THEN 2560 ELSE 768 END AS dims
    FROM benchmark
    """
)
def embedding_dims(spark, sf_dir):
    model = (
        F.when(F.col("item_id") % 4 == 0, "ai/embeddinggemma")
        .when(F.col("item_id") % 4 == 1, "ai/snowflake-arctic-embed")
        .when(F.col("item_id") % 4 == 2, "ai/qwen3-embedding")
        .otherwise("other")
    )
    return table(spark, sf_dir, "benchmark").select("item_id", fn.embedding_dims(model).alias("dims"))


@query(
    f"""
    SELECT doc_id AS id, md5(head || cut) AS tags_part, md5(head || cut) AS summary_part,
           md5(head || hex(encode(text))) AS whole_part
    FROM (SELECT doc_id, text, {_sql_cut(20000)} AS cut,
                 hex(encode('Title: Title ' || doc_id || chr(10) || chr(10))) AS head
          FROM documents)
    """
)
def enrichment_prompts(spark, sf_dir):
    """What of a document a model is given, with a limit and without one."""
    named = documents_table(spark, sf_dir).withColumn("title", F.concat(F.lit("Title "), "id"))
    prompts = named.withColumn(
        "cut", fn.enrichment_prompts("title", "content", MODEL_INPUT_BYTES)
    ).withColumn("whole", fn.enrichment_prompts("title", "content"))
    # The part after the task, which is worded by this library.
    rest = lambda c: F.regexp_replace(c, r"(?s)\A.*?(?=Title: )", "")
    part = lambda c: F.md5(F.hex(rest(c).cast("binary")))
    return prompts.select(
        "id",
        part("cut.tags_prompt").alias("tags_part"),
        part("cut.summary_prompt").alias("summary_part"),
        part("whole.tags_prompt").alias("whole_part"),
    )


@query(
    f"""
    WITH tokens AS MATERIALIZED (SELECT doc_id, {r.words('text')} AS w FROM documents),
    tf AS (
        SELECT doc_id, term, count(*) AS tf
        FROM (SELECT doc_id, unnest(w) AS term FROM tokens) GROUP BY doc_id, term
    )
    SELECT 'content' AS field, term, doc_id AS id, tf, len(w) AS len FROM tf JOIN tokens USING (doc_id)
    """,
    name="build_postings",
)
def postings(spark, sf_dir):
    return build_postings(documents_table(spark, sf_dir), {"content": STANDARD})


@query(
    f"""
    WITH tokens AS (SELECT doc_id, unnest({r.words('text')}) AS term FROM documents)
    SELECT 'content' AS field, term, count(DISTINCT doc_id) AS df, count(*) AS cf
    FROM tokens GROUP BY term
    """
)
def vocabulary(spark, sf_dir):
    rows = build_postings(documents_table(spark, sf_dir), {"content": STANDARD})
    totals = rows.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    return totals


@query(
    f"""
    SELECT 'content' AS field, count(*) AS doc_count, round(avg(n), 6) AS avg_len
    FROM (SELECT len({r.words('text')}) AS n FROM documents) WHERE n > 0
    UNION ALL
    SELECT 'source', count(*), round(avg(n), 6)
    FROM (SELECT len({r.words('source')}) AS n FROM documents) WHERE n > 0
    """
)
def corpus_stats(spark, sf_dir):
    fields = {"content": STANDARD, "source": STANDARD}
    stats = field_stats(documents_table(spark, sf_dir), fields)
    return stats.select("field", "doc_count", F.round("avg_len", 6).alias("avg_len"))


@query(
    f"""
    WITH docs AS (SELECT count(*) AS n FROM documents),
    tokens AS (SELECT doc_id, unnest({r.words('text')}) AS term FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    ranked AS (
        SELECT doc_id, term,
               row_number() OVER (
                   PARTITION BY doc_id
                   ORDER BY round(tf * ln(n::DOUBLE / df), 9) DESC, term) AS rank
        FROM tf JOIN df USING (term), docs
    )
    SELECT doc_id AS id, string_agg(term, ' ' ORDER BY rank) AS tags
    FROM ranked WHERE rank <= 15 GROUP BY doc_id
    """,
    name="tfidf_tags",
)
def tags_by_tfidf(spark, sf_dir):
    tags = tfidf_tags(documents_table(spark, sf_dir))
    return tags.select("id", F.array_join("tags", " ").alias("tags"))


@query(
    f"""
    WITH made AS (
        SELECT doc_id, '# Title' || chr(10) || chr(10) || replace(text, chr(10), chr(10) || chr(10)) AS content
        FROM documents
    )
    SELECT doc_id AS id,
           list_extract(list_filter(
               list_transform(regexp_split_to_array(content, '\\n[\\t\\r ]*\\n'), lambda x: {r.trim('x')}),
               lambda x: x <> '' AND NOT starts_with(x, '#')), 1) AS summary
    FROM made
    """,
    name="lead_summary",
)
def summary_by_lead(spark, sf_dir):
    content = F.concat(F.lit("# Title\n\n"), F.replace("content", F.lit("\n"), F.lit("\n\n")))
    return documents_table(spark, sf_dir).select("id", lead_summary(content).alias("summary"))
