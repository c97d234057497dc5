"""Markdown detection and titles."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column, trim_ws

# Fixed values. `\s` is spelled out and `d` limits line ends to \n, so that Java
# regular expressions agree with RE2 on carriage returns and vertical tabs.
_SPACE = r"[\t\n\f\r ]"
_INK = r"[^\t\n\f\r ]"
HEADING_AT_START = rf"\A#{{1,6}}{_SPACE}+{_INK}"
LIST_LINE = rf"(?m:^)[-*]{_SPACE}+{_INK}"
INLINE_LINK = r"\[.+?\]\(.+?\)"

MARKDOWN_TYPES = ("text/markdown", "text/x-markdown")
MARKDOWN_SUFFIXES = (".md", ".markdown")
HTML_STARTS = ("<!doctype", "<html", "<head", "<body")


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out


def is_markdown_content_type(content_type: Column | str) -> Column:
    value = F.lower(as_column(content_type))
    return _any([value.startswith(t) for t in MARKDOWN_TYPES])


def is_markdown_url(url: Column | str) -> Column:
    value = F.lower(as_column(url))
    return _any([value.endswith(s) for s in MARKDOWN_SUFFIXES])


def looks_like_html(content: Column | str) -> Column:
    # Only the first bytes decide, so only they are lower-cased.
    start = F.lower(F.substring(as_column(content), 1, 16))
    return _any([start.startswith(s) for s in HTML_STARTS])


def has_markdown_patterns(trimmed: Column | str) -> Column:
    """One regular expression, so that a text is read once."""
    return as_column(trimmed).rlike(rf"(?d){HEADING_AT_START}|{LIST_LINE}|{INLINE_LINK}")


def is_markdown_content(content: Column | str) -> Column:
    text = trim_ws(content)
    return (text != "") & ~looks_like_html(text) & has_markdown_patterns(text)


def detect_markdown(
    url: Column | str, content_type: Column | str, content: Column | str
) -> Column:
    """Content type, then URL, then content; a missing value counts as empty."""

    def given(c: Column | str) -> Column:
        return F.coalesce(as_column(c), F.lit(""))

    return (
        F.when(is_markdown_content_type(given(content_type)), True)
        .when(is_markdown_url(given(url)), True)
        .otherwise(is_markdown_content(given(content)))
    )


def markdown_title(content: Column | str) -> Column:
    """Text of the first line that is a level-one heading, or the empty string."""
    lines = F.transform(F.split(as_column(content), "\n"), trim_ws)
    headings = F.filter(lines, lambda line: line.startswith("# "))
    return F.coalesce(F.substring(F.get(headings, F.lit(0)), 3, 2**31 - 1), F.lit(""))


def title_or_url(title: Column | str, url: Column | str) -> Column:
    return F.coalesce(F.nullif(as_column(title), F.lit("")), as_column(url))
