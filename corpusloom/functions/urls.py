"""URL and object-key functions."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .markdown import is_markdown_url
from .text import as_column


def document_id(url: Column | str) -> Column:
    """First 16 hex digits of the SHA-256 of the URL as given."""
    return F.substring(F.sha2(as_column(url), 256), 1, 16)


def url_host(url: Column | str) -> Column:
    """``host[:port]`` without user info; null when the URL does not parse."""
    authority = F.try_parse_url(as_column(url), F.lit("AUTHORITY"))
    return F.regexp_replace(authority, r"^.*@", "")


def _once(value: Column, function: Callable[[Column], Column]) -> Column:
    """``function(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def _without_dots(path: Column) -> Column:
    """Fold dot segments: ``.`` names the folder itself, ``..`` the one above."""

    def step(parts: Column, part: Column) -> Column:
        above = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
        more = F.concat(parts, F.array(part))
        return F.when(part == "..", above).when(part == ".", parts).otherwise(more)

    # A dot segment at the end names a folder.
    whole = F.regexp_replace(path, r"(?s)(/\.\.?)\z", "$1/")
    return F.array_join(F.aggregate(F.split(whole, "/"), F.array().cast("array<string>"), step), "/")


def _resolve(base: Column, href: Column, origin: Column) -> Column:
    """A path, relative path or query against a base with the given origin."""
    path = F.regexp_extract(href, r"(?s)^[^?#]*", 0)
    query = F.regexp_extract(href, r"(?s)^[^?#]*(\?[^#]+)", 1)
    fragment = F.regexp_extract(href, r"(?s)^[^#]*(#.+)", 1)
    after = F.substr(base, F.length(origin) + 1)
    base_path = F.regexp_extract(after, r"(?s)^[^?#]*", 0)
    base_query = F.regexp_extract(after, r"(?s)^[^?#]*(\?[^#]+)", 1)
    folder = F.regexp_replace(base_path, r"(?s)[^/]+\z", "")
    relative = F.regexp_replace(F.concat(F.lit("/"), folder, path), "/{2,}", "/")
    full = F.when(path.startswith("/"), path).otherwise(relative)
    folded = _once(full, lambda p: F.when(p.rlike(r"/\.\.?(/|\z)"), _without_dots(p)).otherwise(p))
    rooted = _once(folded, lambda p: F.when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p)))
    asked = F.when((path == "") & (query == ""), base_query).otherwise(query)
    return F.concat(origin, F.when(path == "", base_path).otherwise(rooted), asked, fragment)


def _percent_encode(url: Column) -> Column:
    """Percent-encode spaces and non-ASCII characters, as UTF-8."""
    pieces = F.regexp_extract_all(url, F.lit(r"[\x00-\x7F]+|[^\x00-\x7F]+"), F.lit(0))
    encoded = F.array_join(
        F.transform(pieces, lambda p: F.when(p.rlike(r"^[\x00-\x7F]"), p).otherwise(F.url_encode(p))),
        "",
    )
    return F.when(
        url.rlike(r"[^\x21-\x7E]"), F.replace(encoded, F.lit(" "), F.lit("%20"))
    ).otherwise(url)


def absolute_url(base: Column | str, href: Column | str) -> Column:
    """Resolve ``href`` against the URL of its page or the page's base, in the JVM.

    Dot segments are folded over the parts of the path. White space around the href and
    line breaks and tabs in it do not count. A fragment alone names the page itself and
    gives null; a base without ``scheme://`` leaves the href as it is. Characters
    outside ASCII come out percent-encoded.
    """
    base, href = as_column(base), as_column(href)
    edges = r"^[\x00-\x20]+|[\x00-\x20]+\z|[\t\r\n]+"
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)

    def resolved(href: Column) -> Column:
        absolute = href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:") | (origin == "")
        dotted = href.rlike(r"/\.\.?(/|\z|[?#])")
        return (
            F.when(href.startswith("#"), F.lit(None).cast("string"))
            .when(absolute, href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/") & ~dotted, F.concat(origin, href))
            .otherwise(_resolve(base, href, origin))
        )

    return _once(_once(F.regexp_replace(href, edges, ""), resolved), _percent_encode)


def markdown_url_variants(url: Column | str) -> Column:
    """URLs under which a Markdown form of the page may exist."""
    url = as_column(url)
    raw = F.regexp_replace(url, r"(?s)^(.*?)github\.com", "$1raw.githubusercontent.com")
    raw = F.regexp_replace(raw, r"(?s)^(.*?)/blob/", "$1/")
    return (
        F.when(url.contains("github.com") & url.contains("/blob/"), F.array(raw))
        .when(is_markdown_url(url), F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.regexp_replace(url, r"(?s)/\z", ""), F.lit(".md"))))
    )


def scrape_run(url: Column | str, at: Column | str) -> Column:
    """``{UTC time}-{8 hex}``: the last part of a scrape prefix."""
    at = as_column(at)
    nanos = (F.unix_micros(at) * 1000).cast("string")
    short = F.substring(document_id(F.concat_ws("-", as_column(url), nanos)), 1, 8)
    return F.concat_ws("-", F.date_format(at, "yyyy-MM-dd'T'HH-mm-ss"), short)


def scrape_prefix(url: Column | str, at: Column | str) -> Column:
    """``scrapes/{host}/{run}``; the time is an argument so that runs repeat."""
    return F.concat_ws("/", F.lit("scrapes"), url_host(url), scrape_run(url, at))


def object_key(prefix: Column | str, doc_id: Column | str) -> Column:
    return F.concat(as_column(prefix), F.lit("/pages/"), as_column(doc_id), F.lit(".md"))


def manifest_key(prefix: Column | str) -> Column:
    return F.concat(as_column(prefix), F.lit("/metadata.json"))


def object_name(key: Column | str) -> Column:
    """Last path element of an object key."""
    return F.regexp_extract(as_column(key), r"([^/]+)$", 1)
