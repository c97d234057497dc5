"""HTML functions: native title, Arrow-batched conversion to Markdown."""

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import as_column, trim_ws

# Character references decoded by the native title; HTML lets all
# of them stand without the semicolon.
TITLE_ENTITIES = {
    "&lt;?": "<",
    "&gt;?": ">",
    "&quot;?": '"',
    "&#39;?": "'",
    "&nbsp;?": "\u00a0",
    "&copy;?": "©",
    "&middot;?": "·",
    "&amp;?": "&",
}

CONVERTED = T.StructType(
    [
        T.StructField("markdown", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
_ARROW_CONVERTED = pa.struct([(name, pa.string()) for name in CONVERTED.names])
#: Pages that are converted before their results go into an Arrow array.
ROWS_AT_ONCE = 64


def html_title(html: Column | str) -> Column:
    """Trimmed text of the last non-empty ``<title>``, or the empty string.

    JVM-only; covers the entities above. :func:`html_to_markdown` decodes all.
    """
    found = F.regexp_extract_all(
        as_column(html), F.lit(r"(?is)<title(?:[\s/][^>]*)?>([^<]+)</title"), F.lit(1)
    )
    title = F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))
    decoded = title
    for entity, text in TITLE_ENTITIES.items():
        decoded = F.regexp_replace(decoded, entity, text)
    return trim_ws(F.when(title.contains("&"), decoded).otherwise(title))


_SKIPPED = {"script", "style", "noscript", "template"}
_HEAD_ONLY = _SKIPPED | {"head", "meta", "link", "title", "base"}
_BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "dd", "details", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "header", "hr", "html",
    "main", "nav", "ol", "p", "pre", "section", "table", "tbody", "thead", "tr", "ul",
}
_HEADINGS = {f"h{n}": n for n in range(1, 7)}
_EMPHASIS = {"b": "**", "strong": "**", "i": "*", "em": "*"}


class _MarkdownWriter(HTMLParser):
    """Collects Markdown blocks; tolerant of unclosed and stray tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.run: list[str] = []
        self.prefix = ""
        self.title: str | None = None
        self.title_parts: list[str] | None = None
        self.skip = 0
        self.in_head = False
        self.pre = 0
        self.lists: list[int] = []
        self.links: list[tuple[int, str]] = []

    def end_block(self):
        text = "".join(self.run)
        self.run = []
        self.links = []
        if self.pre:
            text = text.strip("\n")
            if text.strip():
                self.blocks.append(f"```\n{text}\n```")
        else:
            lines = [" ".join(line.split()) for line in text.split("\n")]
            text = "\n".join(line for line in lines if line)
            if text:
                self.blocks.append(self.prefix + text)
                self.prefix = ""

    def handle_starttag(self, tag, attrs):
        if tag == "title":
            self.title_parts = []
        elif tag in _SKIPPED:
            self.skip += 1
        elif tag == "head":
            self.in_head = True
        if tag not in _HEAD_ONLY:
            self.in_head = False
        if self.skip or self.title_parts is not None:
            return
        if tag in _HEADINGS:
            self.end_block()
            self.prefix = "#" * _HEADINGS[tag] + " "
        elif tag == "li":
            self.end_block()
            depth = max(len(self.lists) - 1, 0)
            if self.lists and self.lists[-1] >= 0:
                self.lists[-1] += 1
                self.prefix = "  " * depth + f"{self.lists[-1]}. "
            else:
                self.prefix = "  " * depth + "- "
        elif tag in _BLOCKS:
            self.end_block()
            if tag in ("ul", "ol"):
                self.lists.append(0 if tag == "ol" else -1)
            elif tag == "pre":
                self.pre += 1
            elif tag == "blockquote":
                self.prefix = "> "
            elif tag == "hr":
                self.blocks.append("---")
        elif tag == "br":
            self.run.append("\n")
        elif tag == "a":
            self.links.append((len(self.run), dict(attrs).get("href") or ""))
        elif tag == "code" and not self.pre:
            self.run.append("`")
        elif tag == "img":
            given = dict(attrs)
            if given.get("src"):
                self.run.append(f"![{given.get('alt') or ''}]({given['src']})")
        elif tag in ("td", "th"):
            self.run.append(" ")
        elif tag in _EMPHASIS:
            self.run.append(_Mark(_EMPHASIS[tag]))

    def handle_endtag(self, tag):
        if tag == "title":
            text = "".join(self.title_parts or ())
            if text:
                self.title = text
            self.title_parts = None
            return
        if tag in _SKIPPED:
            self.skip = max(self.skip - 1, 0)
            return
        if tag == "head":
            self.in_head = False
        if self.skip:
            return
        if tag == "pre":
            self.end_block()
            self.pre = max(self.pre - 1, 0)
        elif tag in ("ul", "ol"):
            self.end_block()
            if self.lists:
                self.lists.pop()
        elif tag in _HEADINGS or tag in _BLOCKS or tag == "li":
            self.end_block()
            self.prefix = ""
        elif tag == "a" and self.links:
            at, href = self.links.pop()
            text = "".join(self.run[at:]).strip()
            if text and href:
                self.run[at:] = [f"[{text}]({href})"]
        elif tag == "code" and not self.pre:
            self.run.append("`")
        elif tag in _EMPHASIS:
            self.close_mark(_EMPHASIS[tag])

    def close_mark(self, mark: str):
        """Turn the matching open mark into text; unmatched marks stay silent."""
        for at in range(len(self.run) - 1, -1, -1):
            piece = self.run[at]
            if isinstance(piece, _Mark) and piece.text == mark:
                inner = "".join(self.run[at + 1 :]).strip()
                if inner:
                    self.run[at:] = [f"{mark}{inner}{mark}"]
                return

    def handle_data(self, data):
        if self.title_parts is not None:
            self.title_parts.append(data)
        elif not self.skip and not self.in_head:
            self.run.append(data if self.pre else data.replace("\n", " "))

    def finish(self) -> tuple[str, str]:
        self.close()
        if self.title_parts:
            self.title = "".join(self.title_parts)
        self.end_block()
        return _join_blocks(self.blocks), (self.title or "").strip()


class _Mark(str):
    """An open emphasis tag: joins as nothing until its end tag is seen."""

    def __new__(cls, text):
        mark = super().__new__(cls, "")
        mark.text = text
        return mark


def _join_blocks(blocks: list[str]) -> str:
    out = []
    for block in blocks:
        item = block.lstrip().startswith("- ")
        out.append(("\n" if item and out and last_item else "\n\n") if out else "")
        out.append(block)
        last_item = item
    return "".join(out).strip()


def _convert_one(html: str | None) -> tuple[str | None, str | None, str | None]:
    if html is None:
        return None, None, None
    try:
        writer = _MarkdownWriter()
        writer.feed(html)
        markdown, title = writer.finish()
        return markdown, title, None
    except Exception as error:  # one bad page must not fail its task
        return None, None, f"convert: {error}"


@F.arrow_udf(CONVERTED)
def _convert(html: pa.Array) -> pa.Array:
    # Pages are Python strings a few at a time, so that a batch is held in Arrow form only.
    parts = [
        pa.array(
            [dict(zip(CONVERTED.names, _convert_one(page.as_py()))) for page in html[at : at + ROWS_AT_ONCE]],
            _ARROW_CONVERTED,
        )
        for at in range(0, len(html), ROWS_AT_ONCE)
    ]
    return pa.concat_arrays(parts) if parts else pa.array([], _ARROW_CONVERTED)


def html_to_markdown(html: Column | str) -> Column:
    """``struct(markdown, title, error)``; null input passes through untouched."""
    return _convert(as_column(html))
