from corpusloom import functions as fn


def test_content_types(column):
    given = ["text/markdown", "TEXT/X-Markdown", "text/markdown; charset=utf-8", "text/html",
             "text/plain", "", " text/markdown"]
    assert column(fn.is_markdown_content_type, given) == [True, True, True, False, False, False, False]


def test_urls(column):
    given = ["https://h.example/a/NOTES.md", "https://h.example/a.markdown", "https://h.example/A.MD",
             "https://h.example/a.html", "https://h.example/md/a", "https://h.example/a.md?raw=1",
             "https://h.example/a.md#top"]
    assert column(fn.is_markdown_url, given) == [True, True, True, False, False, False, False]


def test_content(column):
    cases = {
        "# One\n\ntext": True,
        "###### Six": True,
        "####### Seven": False,
        "#NoSpace": False,
        "\n\t ## After blanks": True,
        "text first\n# then a heading": False,
        "- item\n- item": True,
        "text\n* item": True,
        "-dash": False,
        "see [docs](https://h.example)": True,
        "[broken\ntext](https://h.example)": False,
        "nothing special here": False,
        "": False,
        "   ": False,
        "<!DOCTYPE html><p>[a](b)</p>": False,
        "  <HTML><body># x</body></HTML>": False,
        "<header>\n- item</header>": False,
        "<p>\n- item</p>": True,
        # Only \n ends a line, and \v is no space of a pattern.
        "x\r- a": False,
        "[a\rb](c)": True,
        "#\vx": False,
        "- \vx": True,
    }
    assert column(fn.is_markdown_content, list(cases)) == list(cases.values())


def test_detection_order(column):
    given = [
        ("https://h.example/p", "text/markdown", "<html></html>"),
        ("https://h.example/p.md", "text/html", "<html></html>"),
        ("https://h.example/p", "text/plain", "# Heading"),
        ("https://h.example/p", "text/html", "<html># Heading</html>"),
        (None, None, None),
    ]
    assert column(fn.detect_markdown, given) == [True, True, True, False, False]


def test_titles(column):
    cases = {
        "# Guide\ntext": "Guide",
        "intro\n  # Indented # \n# Second": "Indented #",
        "## Minor\n#No\n#": "",
        "#  Two blanks": " Two blanks",
        "": "",
    }
    assert column(fn.markdown_title, list(cases)) == list(cases.values())
    given = [("T", "u"), ("", "u"), (None, "u")]
    assert column(fn.title_or_url, given) == ["T", "u", "u"]


def test_trim_and_tags(column):
    assert column(fn.trim_ws, ["　\x85a b \v", " \t ", "", "​x"]) == [
        "a b", "", "", "​x",
    ]
    tags = column(fn.parse_tags, ["a, b ,, c d, a", " , ", ""])
    assert tags == [["a", "b", "c d", "a"], [], []]


def test_truncation_is_by_bytes(column):
    cut = column(lambda c: fn.truncate_bytes(c, 5), ["abcde", "abcdef", "abcdé", "éé", "abc€", None])
    assert cut == ["abcde", "abcde", "abcd�", "éé", "abc�", None]
