"""Links, crawls, conversion, enrichment and document building."""

from pyspark.sql import functions as F

from ..functions import url_host
from ..operators.analysis import analyze
from ..operators.documents import build_documents, html_to_markdown_job
from ..operators.enrich import embed, embed_default, enrich
from ..operators.links import crawl, crawl_frontier, extract_links, pages_in_frontier
from ..operators.variants import prefer_markdown_variant
from . import registry as r
from .registry import documents_table, pages_table, query, table
from .text import sql_html_title

_HREF = "href\\s*=\\s*(?:\"([^\"]*)\"|''([^'']*)''|([^\\s\"''>]+))"


def _sql_links(source: str) -> str:
    """``src_url, dst_url`` of all anchors; the hrefs of the data are absolute,
    absolute paths or fragments."""
    group = " || ".join(
        f"regexp_extract(tag, '(?is)\\s{_HREF}$', {n})" for n in (1, 2, 3)
    )
    return f"""
    tags AS (
        SELECT url AS src_url, unnest(regexp_extract_all(html, '(?is)<a\\s(?:[^>]*?\\s)?{_HREF}')) AS tag
        FROM {source}
    ),
    hrefs AS (SELECT src_url, trim(replace({group}, '&amp;', '&')) AS href FROM tags),
    resolved AS (
        SELECT src_url,
               CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
                    WHEN starts_with(href, '//') THEN regexp_extract(src_url, '^[a-z]+:') || href
                    WHEN starts_with(href, '/') THEN regexp_extract(src_url, '^[a-z]+://[^/?#]*') || href
                    WHEN href = '..' THEN regexp_extract(src_url, '^[a-z]+://[^/?#]*') || '/'
                    END AS url
        FROM hrefs WHERE href <> '' AND NOT starts_with(href, '#')
    ),
    links AS (
        SELECT DISTINCT src_url,
               array_to_string(list_transform(regexp_extract_all(url, '[\\x00-\\x7F]+|[^\\x00-\\x7F]+'),
                   lambda x: CASE WHEN regexp_matches(x, '^[\\x00-\\x7F]') THEN replace(x, ' ', '%20')
                             ELSE url_encode(x) END), '') AS dst_url
        FROM resolved WHERE url IS NOT NULL
    )"""


@query(
    f"""
    WITH {_sql_links('pages')}
    SELECT src_url, dst_url, {r.host('src_url')} = {r.host('dst_url')} AS same_host FROM links
    """,
    name="extract_links_all_hosts",
)
def links_all(spark, sf_dir):
    edges = extract_links(pages_table(spark, sf_dir), same_host=False)
    return edges.withColumn("same_host", url_host("src_url") == url_host("dst_url"))


_MORE_ANCHORS = (
    "html || '<a href=\"https://other.example.org/x y\">o</a><A class=''b'' HREF=''//' || "
    f"{r.host('url')} || '/up?q=1&amp;r=2''>u</A><a data-href=\"/no\" href=/bare>b</a>"
    "<a href=\"#top\">t</a><a name=\"n\">n</a><a href=\"/é ü\">e</a>'"
)


@query(
    f"""
    WITH made AS (SELECT url, {_MORE_ANCHORS} AS html FROM pages), {_sql_links('made')}
    SELECT src_url, dst_url FROM links WHERE {r.host('src_url')} = {r.host('dst_url')}
    """,
    name="extract_links",
)
def links_same_host(spark, sf_dir):
    more = F.concat(
        F.lit("<a href=\"https://other.example.org/x y\">o</a><A class='b' HREF='//"),
        url_host("url"),
        F.lit(
            "/up?q=1&amp;r=2'>u</A><a data-href=\"/no\" href=/bare>b</a>"
            "<a href=\"#top\">t</a><a name=\"n\">n</a><a href=\"/é ü\">e</a>"
        ),
    )
    pages = pages_table(spark, sf_dir)
    return extract_links(pages.withColumn("body", F.concat("body", more)))


_SITE = "https://site.example.org/p/"


def _made_edges(spark, sf_dir):
    """Page i links to pages 4i+1..4i+4, back to page 0 and to another host."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("i"))
    child = F.explode(F.array(*[F.col("i") * 4 + n for n in range(1, 5)]))
    tree = pages.select("i", child.alias("j")).join(pages.select(F.col("i").alias("j")), "j")

    def site(column):
        return F.concat(F.lit(_SITE), column)

    return (
        tree.select(site("i").alias("src_url"), site("j").alias("dst_url"))
        .unionByName(tree.select(site("i").alias("src_url"), F.concat(site("j"), F.lit("#top")).alias("dst_url")))
        .unionByName(pages.select(site("i").alias("src_url"), F.lit(_SITE + "0#again").alias("dst_url")))
        .unionByName(
            pages.select(site("i").alias("src_url"), F.lit("https://other.example.org/").alias("dst_url"))
        )
    )


@query(
    f"""
    WITH RECURSIVE edges AS (
        SELECT a.page_id AS i, b.page_id AS j FROM pages a JOIN pages b
        ON b.page_id BETWEEN 4 * a.page_id + 1 AND 4 * a.page_id + 4
        UNION ALL SELECT page_id, 0 FROM pages
    ),
    walk AS (
        SELECT seed, seed AS i, 1 AS depth FROM (VALUES (0::BIGINT), (2), (7)) s(seed)
        UNION
        SELECT seed, j, depth + 1 FROM walk JOIN edges USING (i) WHERE depth < 5
    )
    SELECT '{_SITE}' || seed AS seed_url,
           '{_SITE}' || i || CASE WHEN i = 0 AND seed <> 0 THEN '#again' ELSE '' END AS url,
           min(depth) AS depth
    FROM walk GROUP BY seed, i
    """,
    name="crawl_frontier",
)
def crawl_by_depth(spark, sf_dir):
    seeds = spark.sql(f"SELECT '{_SITE}' || i AS url FROM VALUES (0), (2), (7) AS seeds(i)")
    return crawl_frontier(seeds, _made_edges(spark, sf_dir), 5)


@query(
    f"""
    WITH RECURSIVE edges AS (
        SELECT a.page_id AS i, b.page_id AS j FROM pages a JOIN pages b
        ON b.page_id BETWEEN 4 * a.page_id + 1 AND 4 * a.page_id + 4
        UNION ALL SELECT page_id, 0 FROM pages
    ),
    walk AS (
        SELECT page_id AS seed, page_id AS i, 1 AS depth FROM pages
        UNION
        SELECT seed, j, depth + 1 FROM walk JOIN edges USING (i) WHERE depth < 5
    )
    SELECT '{_SITE}' || seed AS seed_url,
           '{_SITE}' || i || CASE WHEN i = 0 AND seed <> 0 THEN '#again' ELSE '' END AS url,
           min(depth) AS depth
    FROM walk GROUP BY seed, i
    """,
    name="crawl_from_all_pages",
)
def crawl_by_bitmaps(spark, sf_dir):
    """Every page is a seed: a round has a row per URL, not per seed and URL."""
    seeds = table(spark, sf_dir, "pages").select(F.concat(F.lit(_SITE), "page_id").alias("url"))
    return crawl_frontier(seeds, _made_edges(spark, sf_dir), 5, bitmap_seeds=1)


@query(
    f"""
    WITH RECURSIVE walk AS (
        SELECT 0::BIGINT AS i, 1 AS depth
        UNION
        SELECT page_id, depth + 1 FROM walk JOIN pages
        ON page_id BETWEEN 4 * i + 1 AND 4 * i + 4
    )
    SELECT '{_SITE}0' AS seed_url, '{_SITE}' || i AS url, depth FROM walk
    """,
    name="crawl_frontier_unbounded",
)
def crawl_to_the_end(spark, sf_dir):
    seeds = spark.sql(f"SELECT '{_SITE}0' AS url")
    return crawl_frontier(seeds, _made_edges(spark, sf_dir), 0)


@query(
    f"""
    WITH {_sql_links('pages')},
    seeds AS (SELECT DISTINCT url, regexp_replace(url, '(?s)#.*$', '') AS key FROM pages),
    keyed AS (
        SELECT url, html, regexp_replace(url, '(?s)#.*$', '') AS key FROM pages
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY url, page_id DESC) = 1
    ),
    hops AS (
        SELECT DISTINCT regexp_replace(src_url, '(?s)#.*$', '') AS src,
               regexp_replace(dst_url, '(?s)#.*$', '') AS dst
        FROM links WHERE {r.host('src_url')} = {r.host('dst_url')}
    ),
    reached AS (
        SELECT url AS seed_url, key, 1 AS depth FROM seeds
        UNION ALL
        SELECT s.url, h.dst, 2 FROM seeds s JOIN hops h ON h.src = s.key AND h.dst <> s.key
    )
    SELECT seed_url, k.url, md5(html) AS body, min(depth) AS depth
    FROM reached JOIN keyed k USING (key) GROUP BY ALL
    """
)
def crawl_pages(spark, sf_dir):
    """Every page is a seed; pages two levels deep that were fetched."""
    pages = pages_table(spark, sf_dir)
    reached = crawl(pages, pages.select("url"), 2)
    return reached.select("seed_url", "url", F.md5("body").alias("body"), "depth")


@query(
    """
    SELECT p.page_id, p.url, md5(html) AS body FROM pages p
    WHERE page_id % 5 <> 0 AND regexp_replace(url, '(?s)#.*$', '') IN (
        SELECT regexp_replace(url, '(?s)#.*$', '') FROM pages WHERE page_id % 2 = 0)
    """,
    name="pages_in_frontier",
)
def visited_pages(spark, sf_dir):
    """Every second page was visited, with another fragment; every fifth failed."""
    pages = pages_table(spark, sf_dir)
    seen = pages.where(F.col("page_id") % 2 == 0).select(
        F.concat(F.regexp_replace("url", r"(?s)#.*\z", ""), F.lit("#seen")).alias("url")
    )
    status = F.when(F.col("page_id") % 5 == 0, 404).otherwise(200)
    found = pages_in_frontier(pages.withColumn("status", status), seen)
    return found.select("page_id", "url", F.md5("body").alias("body"))


@query(
    f"""
    WITH twins AS (
        SELECT regexp_replace(url, '/$', '') || '.md' AS url, '# Twin of ' || page_id AS body
        FROM pages WHERE page_id % 2 = 0 AND page_id % 5 <> 0
    )
    SELECT p.page_id, p.url,
           CASE WHEN t.url IS NULL THEN 'text/html' ELSE 'text/plain' END AS content_type,
           md5(coalesce(t.body, p.html)) AS body
    FROM pages p LEFT JOIN twins t ON t.url = regexp_replace(p.url, '/$', '') || '.md'
    """,
    name="prefer_markdown_variant",
)
def markdown_variant(spark, sf_dir):
    """Every second page was also fetched as Markdown, some of them with an error."""
    pages = pages_table(spark, sf_dir)
    twins = pages.where(F.col("page_id") % 2 == 0).select(
        F.concat(F.regexp_replace("url", r"/\z", ""), F.lit(".md")).alias("url"),
        F.when(F.col("page_id") % 5 == 0, 404).otherwise(200).alias("status"),
        F.lit("text/plain").alias("content_type"),
        F.concat(F.lit("# Twin of "), "page_id").alias("body"),
    )
    fetched = pages.select("url", "status", "content_type", "body").unionByName(twins)
    chosen = prefer_markdown_variant(pages, fetched)
    return chosen.select("page_id", "url", "content_type", F.md5("body").alias("body"))


def _sql_visible_words(html: str) -> str:
    text = html
    for pattern in (
        "(?is)<head.*?</head>",
        "(?is)<script.*?</script>",
        "(?s)<!--.*?-->",
        "(?s)<[^>]*>",
    ):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    for entity, shown in (("&copy;?", "©"), ("&middot;?", "·"), ("&quot;?", '"'), ("&amp;?", "&")):
        text = f"regexp_replace({text}, '{entity}', '{shown}', 'g')"
    return r.words(text)


@query(
    f"""
    SELECT page_id, {sql_html_title('html')} AS title, false AS failed,
           len({_sql_visible_words('html')}) AS n_words,
           md5(array_to_string({_sql_visible_words('html')}, ' ')) AS words
    FROM pages
    """
)
def html_to_markdown(spark, sf_dir):
    """Every visible word of every page survives the conversion, in order."""
    converted = html_to_markdown_job(pages_table(spark, sf_dir))
    text = F.regexp_replace("markdown", r"\]\([^)\n]*\)", "]")
    found = converted.select("page_id", "title", "error", analyze(text).alias("w"))
    return found.select(
        "page_id",
        "title",
        F.col("error").isNotNull().alias("failed"),
        F.size("w").cast("bigint").alias("n_words"),
        F.md5(F.array_join("w", " ")).alias("words"),
    )


@query(
    f"""
    WITH rows AS (
        SELECT url, 'text/html' AS content_type, html AS body, {sql_html_title('html')} AS title,
               NULL AS content
        FROM pages
        UNION ALL
        SELECT 'https://docs.example.org/' || doc_id, 'text/markdown',
               text || chr(10) || '# Doc ' || doc_id, 'Doc ' || doc_id,
               md5(text || chr(10) || '# Doc ' || doc_id)
        FROM documents
    )
    SELECT {r.document_id('url')} AS id, url, coalesce(nullif(title, ''), url) AS title, content_type,
           content AS markdown_content, true AS has_content, false AS failed
    FROM rows
    """,
    name="build_documents",
)
def documents_from_pages(spark, sf_dir):
    """HTML pages are converted, Markdown bodies pass through."""
    pages = pages_table(spark, sf_dir).drop("page_id")
    url = F.concat(F.lit("https://docs.example.org/"), "id")
    markdown = documents_table(spark, sf_dir).select(
        url.alias("url"),
        F.lit(200).alias("status"),
        F.lit("text/markdown").alias("content_type"),
        F.concat("content", F.lit("\n# Doc "), "id").alias("body"),
        F.lit(None).cast("timestamp").alias("scraped_at"),
    )
    built = build_documents(pages.unionByName(markdown))
    is_markdown = F.col("content_type") == "text/markdown"
    return built.select(
        "id",
        "url",
        "title",
        "content_type",
        F.when(is_markdown, F.md5("content")).alias("markdown_content"),
        (F.col("content") != "").alias("has_content"),
        F.col("error").isNotNull().alias("failed"),
    )


def _make_text_model():
    def model(titles, contents):
        if any(not t for t in titles):
            raise ValueError("no title")
        return [
            (f" {t} , lines {c.count(chr(10)) + 1},, ", f"\n{len(c)} characters ")
            for t, c in zip(titles, contents)
        ]

    return model


@query(
    """
    SELECT doc_id AS id,
           CASE WHEN lang <> 'de' THEN source || '|lines ' || len(string_split(text, chr(10))) END
               AS tags,
           CASE WHEN lang <> 'de' THEN length(text) || ' characters' END AS summary,
           CASE WHEN lang = 'de' THEN 'ValueError: no title' END AS error
    FROM documents
    """,
    name="enrich",
)
def enrich_with_model(spark, sf_dir):
    """A model that fails for documents without a title."""
    documents = documents_table(spark, sf_dir).withColumn(
        "title", F.when(F.col("lang") == "de", F.lit("")).otherwise(F.col("source"))
    )
    enriched = enrich(documents, _make_text_model)
    return enriched.select(
        "id",
        F.array_join("tags", "|").alias("tags"),
        "summary",
        F.col("enrich_error").alias("error"),
    )


def _make_embedding_model():
    def model(texts):
        if any(not t for t in texts):
            raise ValueError("no text")
        return [
            [float(len(t.encode())), float(t.count("\n"))] + [1.0] * (t.count("\n") % 2)
            for t in texts
        ]

    return model


@query(
    """
    WITH m AS (
        SELECT doc_id, strlen(text) AS n, len(string_split(text, chr(10))) - 1 AS breaks
        FROM documents
    )
    SELECT doc_id AS id,
           CASE WHEN breaks % 2 = 0 THEN n::FLOAT || ' ' || breaks::FLOAT END AS embedding,
           CASE WHEN breaks % 2 = 1 THEN 'embedding: expected 2 values, got 3' END AS error
    FROM m
    """,
    name="embed",
)
def embed_with_model(spark, sf_dir):
    """A model whose vectors have a wrong size for some texts."""
    embedded = embed(documents_table(spark, sf_dir), _make_embedding_model, dims=2)
    shown = F.array_join(F.transform("embedding", lambda x: x.cast("string")), " ")
    return embedded.select(
        "id",
        shown.alias("embedding"),
        F.col("embedding_error").alias("error"),
    )


@query(
    f"""
    WITH tokens AS (
        SELECT doc_id, ('0x' || substr(md5(word), 1, 8))::BIGINT % 256 AS bucket
        FROM (SELECT doc_id, unnest({r.words('text')}) AS word FROM documents)
    ),
    tf AS (SELECT doc_id, bucket, count(*) AS tf FROM tokens GROUP BY ALL),
    idf AS (
        SELECT bucket, ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(*) + 1)) AS idf
        FROM tf GROUP BY bucket
    ),
    weights AS (SELECT doc_id, bucket, tf * idf AS w FROM tf JOIN idf USING (bucket)),
    norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM weights GROUP BY doc_id)
    SELECT doc_id AS id, bucket::INTEGER AS bucket,
           round((CASE WHEN norm > 0 THEN w / norm ELSE 0 END)::FLOAT::DOUBLE, 4) AS value
    FROM weights JOIN norms USING (doc_id)
    WHERE w <> 0
    """,
    name="embed_default",
)
def embed_by_hashing(spark, sf_dir):
    """The values of each vector that are not zero."""
    embedded = embed_default(documents_table(spark, sf_dir), 256)
    values = embedded.select("id", F.posexplode("embedding").alias("bucket", "value"))
    return values.where("value <> 0").select(
        "id", "bucket", F.round(F.col("value").cast("double"), 4).alias("value")
    )
