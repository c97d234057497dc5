from pyspark.util import PythonEvalType

from corpusloom import functions as fn
from corpusloom.functions import pages


def convert(column, pages):
    return column(fn.html_to_markdown, pages)


def test_contract(column):
    page = """<html><head><title>The page</title><style>p{}</style></head><body>
    <h1>Big</h1><h2>Small <em>print</em></h2>
    <p>First
       line.</p><p>Visit <a href="https://h.example/x">the site</a>.</p>
    <pre><code>line one
      line two</code></pre>
    <p>Call <code>run()</code> now.</p>
    <ul><li>red</li><li>blue<ul><li>navy</li></ul></li></ul><ol><li>one</li><li>two</li></ol>
    <!-- hidden --><script>var x = "</p>";</script></body></html>"""
    markdown, title, error = convert(column, [page])[0]
    assert (title, error) == ("The page", None)
    for part in ("# Big", "## Small *print*", "First line.", "[the site](https://h.example/x)",
                 "line one\n      line two", "`run()`", "- red\n- blue", "  - navy", "1. one", "2. two"):
        assert part in markdown, part
    for part in ("hidden", "var x", "p{}", "The page"):
        assert part not in markdown
    assert markdown == markdown.strip()


def test_malformed_pages_keep_their_text(column):
    pages = ["<p>one<b>two<p>three</i></p></div>four", "<head><title>T</title><p>body text",
             "a < b & c &copy; &unknown;", "<li>loose", "<a href=x>link", "</ul></pre>end", ""]
    rows = convert(column, pages)
    assert [r["error"] for r in rows] == [None] * len(pages)
    texts = [r["markdown"] for r in rows]
    for word in ("one", "two", "three", "four"):
        assert word in texts[0]
    assert texts[1] == "body text" and rows[1]["title"] == "T"
    assert texts[2] == "a < b & c © &unknown;"
    assert "loose" in texts[3] and "link" in texts[4] and "end" in texts[5] and texts[6] == ""


def test_titles(column):
    cases = {
        "<title>Plain</title>": "Plain",
        "<title>First</title><svg><title> Last &amp; least </title></svg>": "Last & least",
        "<title>&quot;A &amp;amp; B &amp</title>": '"A &amp; B &',
        "<title>Kept</title><title></title>": "Kept",
        "<TITLE lang=en>\n Upper </TITLE>": "Upper",
        "<titles>no</titles>": "",
        "<p>none</p>": "",
    }
    assert column(fn.html_title, list(cases)) == list(cases.values())
    assert [r["title"] for r in convert(column, list(cases))] == list(cases.values())


def test_null_is_not_converted(column):
    assert list(convert(column, [None])[0]) == [None, None, None]


def test_a_batch_is_never_held_as_python_strings(spark):
    assert pages._convert.evalType == PythonEvalType.SQL_SCALAR_ARROW_UDF
    rows = [(n, None if n % 50 == 7 else f"<title>t{n}</title><p>page <b>{n}</b></p>") for n in range(300)]
    frame = spark.createDataFrame(rows, "n int, html string").coalesce(1)
    found = dict(frame.select("n", fn.html_to_markdown("html")).collect())
    assert len(found) == 300 > pages.ROWS_AT_ONCE
    for n, html in rows:
        want = (None, None, None) if html is None else (f"page **{n}**", f"t{n}", None)
        assert tuple(found[n]) == want
