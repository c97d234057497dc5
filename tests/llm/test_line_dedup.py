import random
import re

from corpusloom.llm import line_dedup
from corpusloom.llm.line_dedup import dedup_lines

SPACE = r"[\x20\x09-\x0D]+"


def shingle_set(line):
    return {line[k : k + 12] for k in range(max(1, len(line) - 11))}


def brute(rows):
    """Removed (id, place) pairs by comparing all lines."""
    lines = []
    for key, text in rows:
        for place, raw in enumerate((text or "").split("\n") if text is not None else ()):
            line = re.sub(SPACE, " ", raw.lower()).strip(" ")
            if line:
                lines.append((key is not None, key or 0, place, line))
    distinct = sorted({line for *_, line in lines})
    sets = [shingle_set(line) for line in distinct]
    root = list(range(len(distinct)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    number = {line: k for k, line in enumerate(distinct)}
    first = {}
    for *at, line in sorted(lines):
        first.setdefault(find(number[line]), at)
    return {
        (key if known else None, place)
        for known, key, place, line in lines
        if first[find(number[line])] != [known, key, place]
    }


def check(make_docs, rows):
    gone = brute(rows)
    found = dedup_lines(make_docs(rows)).collect()
    assert len(found) == len(rows)
    for row in found:
        if row["text"] is None:
            assert row["clean_text"] is None and row["n_lines"] == 0
            continue
        lines = row["text"].split("\n")
        removed = [place for place in range(len(lines)) if (row["doc_id"], place) in gone]
        assert row["n_removed_lines"] == len(removed)
        assert row["removed_chars"] == sum(len(lines[place]) for place in removed)
        assert row["clean_text"] == "\n".join(x for k, x in enumerate(lines) if k not in removed)
        assert row["n_lines"] == len(lines)


def test_against_brute_force(make_docs):
    rng = random.Random(2)
    prose = lambda k: " ".join(f"wort{rng.randrange(5000)}" for _ in range(k))
    shared = [prose(rng.randrange(5, 40)) for _ in range(8)]
    rows = []
    for key in range(60):
        lines = [prose(rng.randrange(1, 30)) for _ in range(rng.randrange(1, 5))]
        for line in rng.sample(shared, 2):
            words = line.split()
            if len(words) > 20 and rng.random() < 0.5:
                words[rng.randrange(len(words))] = "anders"
            lines.insert(rng.randrange(len(lines) + 1), "  ".join(words).upper() if key % 3 else line)
        rows.append((key, "\n".join(lines)))
    rows += [
        (None, shared[0] + "\nshort line"),
        (70, None),
        (71, ""),
        (72, "\n\n"),
        (73, "short line\nshort line"),
        (74, shared[1] + "\n" + shared[1] + "\r\n" + shared[1]),
        (75, "é à ü ß ñ\nÉ À Ü ß Ñ"),
        (76, " ".join(f"long{i}" for i in range(20_000))),
        (77, " ".join(f"long{i}" for i in range(20_000)) + " end"),
        (5, rows[5][1]),
    ]
    check(make_docs, rows)


def test_rows_of_one_id_keep_the_same_lines(make_docs):
    text = "one two three four five six"
    found = dedup_lines(make_docs([(1, text), (1, text), (2, text)])).collect()
    assert sorted((r["doc_id"], r["clean_text"]) for r in found) == [(1, text), (1, text), (2, "")]


def test_rows_of_one_id_and_other_texts_are_documents(make_docs):
    # In the order of a hash of the text, after which the number of kept copies is fixed.
    rows = [(None, f"own line of row {n} alone {n * n}\nshared line of all rows") for n in range(6)]
    found = dedup_lines(make_docs(rows)).collect()
    kept = [row["clean_text"] for row in found]
    assert sorted(text.split("\n")[0] for text in kept) == sorted(t.split("\n")[0] for _, t in rows)
    assert sum("shared" in text for text in kept) == 1


def test_columns_of_any_name(spark):
    names = ["_doc", "_removed", "own_0", "OWN_1", "places", "hash", "place", "version", "n_lines", "key"]
    rows = [(1, "a line that occurs twice", *range(10)), (2, "a line that occurs twice", *range(10))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    found = dedup_lines(docs).orderBy("doc_id").collect()
    assert [row["clean_text"] for row in found] == ["a line that occurs twice", ""]
    assert all(row[name] == at for row in found for at, name in enumerate(names) if name != "n_lines")
    assert [row["n_lines"] for row in found] == [1, 1]


def test_no_filter_repeats_the_shingles(spark, make_docs):
    lines = line_dedup._lines(make_docs([(1, "a b c d e f")]), "doc_id", "text")
    pairs = spark.createDataFrame([(1, 2)], "a long, b long")
    texts = spark.createDataFrame([(1, "x")], "hash long, line string")
    for frame in (line_dedup.with_signatures(lines), line_dedup._linked(texts, pairs)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search(r"Filter .*(lambda.*lambda|array_union.*array_union)", plan)
        assert plan.count("xxhash64(substring") in (0, 2)


def test_empty_table(make_docs):
    assert dedup_lines(make_docs([])).count() == 0


def test_plan_has_no_python(spark, make_docs):
    plan = dedup_lines(make_docs([(1, "a b c d e f")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
