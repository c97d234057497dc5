import re
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import quality_rules as rules
from corpusloom.llm.quality_classifier import (
    Model,
    document_features,
    feature_groups,
    score_documents,
    train,
    training_examples,
)
from corpusloom.llm.quality_rules import RULE_COLUMNS, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n, repeated = len(words), len(inside)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated,
        "base_failed": n < 50 or 100 * repeated > 50 * n,
    }


TEXTS = [
    None,
    "",
    " \n\t\n ",
    "a b c a b c a",
    "é x ###\n###\r\n###\n",
    "x y z " * 40,
    "same line\nsame line\n\n\n same line",
    " ".join(f"w{i}" for i in range(60)) + " a b c d a b c",
    " ".join(f"v{i}" for i in range(30_000)),
    "z" * 200_000,
]


def test_statistics_against_python(make_docs):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[4])]
    found = quality_rules(make_docs(rows)).collect()
    assert len(found) == len(rows)
    for row in found:
        wanted = statistics(row["text"])
        assert {name: row[name] for name in wanted} == wanted
        assert row["kept"] == (not wanted["base_failed"]) and row["clean_text"] == row["text"]
    assert found[0].asDict().keys() >= {*RULE_COLUMNS, "doc_id", "source", "n_spans"}


def test_empty_table(make_docs):
    assert quality_rules(make_docs([])).count() == 0


@pytest.mark.parametrize("host", ["h", None])
def test_boilerplate_by_host(spark, host):
    letters = lambda n: "".join(chr(97 + int(digit)) for digit in str(n))

    def body(k):
        k = k if isinstance(k, str) else letters(k)
        lines = [[f"{k}q{letters(j * 12 + i)}" for i in range(12)] for j in range(5)]
        return "\n".join(map(" ".join, lines))

    banner = "Page 12 of the shop\n"
    rows = [(k, banner.replace("12", str(k)) + body(k), host) for k in range(40)]
    rows += [(100 + k, "Page 1 of the shop\n" * 30, host) for k in range(2)]
    rows += [(200 + k, "copied text here\n" + body("c"), host) for k in range(60)]
    rows += [(300 + k, banner + body("o" + letters(k)), "other") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {row["doc_id"]: row for row in quality_rules(docs).collect()}
    assert found[3]["n_removed_lines"] == 1 and found[3]["clean_text"] == rows[3][1].split("\n", 1)[1]
    assert found[3]["kept"] and found[3]["removed_words"] == 5
    # Only boilerplate: depleted, besides repeating itself.
    assert not found[100]["kept"] and found[100]["n_removed_lines"] == 30
    # Copies of one text count as one document, so they do not reject each other.
    assert all(found[200 + k]["kept"] and found[200 + k]["n_removed_lines"] == 0 for k in range(60))
    assert found[301]["n_removed_lines"] == 0


def test_depleted_document_is_rejected(spark, monkeypatch):
    monkeypatch.setattr(rules, "MIN_WORDS", 1)
    rows = [(k, f"the very same words in every page\nown{chr(97 + k)}", "h") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = quality_rules(docs).collect()
    assert all(not row["kept"] and row["clean_text"].startswith("own") for row in found)


def test_lines_of_few_percent_and_hosts_in_parts(spark, monkeypatch):
    letters = lambda n: "".join(chr(97 + int(digit)) for digit in str(n))
    rows = []
    for k in range(900):
        own = [f"{letters(k)}x{letters(i)} of document {letters(k)}" for i in range(12)]
        lines = (["Share this page"] if k % 30 == 0 else []) + (["Rare line"] if k % 60 == 0 else []) + own
        rows.append((k, "\n".join(lines), "h"))
    rows += [(900, "Share this page\n" + "z", "other"), (901, None, "h"), (None, "Share this page", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    broadcast = {row["doc_id"]: row for row in quality_rules(docs).collect()}
    # 30 of 901 texts are above the limits, 15 are too few.
    assert all(broadcast[k]["n_removed_lines"] == int(k % 30 == 0) for k in range(900))
    assert "Rare line" in broadcast[60]["clean_text"] and broadcast[900]["n_removed_lines"] == 0
    monkeypatch.setattr(rules, "broadcast_if_bounded", lambda df: (df, False))
    parts = {row["doc_id"]: row for row in quality_rules(docs, hot_rows=100).collect()}
    assert parts == broadcast


def test_columns_named_like_inner_ones(spark):
    names = ["frequent", "host", "line", "_words", "_splits", "_salt", "own_0", "own_1", "own_3", "N_WORDS", "_rules"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{name} string" for name in names)
    rows = [(k, "a b c a b c a\nsame line", "h", *names) for k in range(2)]
    for found in quality_rules(spark.createDataFrame(rows, schema)).collect():
        assert [found[name] for name in names if name != "N_WORDS"] == [n for n in names if n != "N_WORDS"]
        assert found["n_words"] == 9 and found["n_repeat_words"] == 7


# The classifier.


def texts_block(texts):
    parts = [t.encode() for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def test_scores_equal_the_vector_average():
    random = np.random.default_rng(0)
    model = Model(random.normal(size=1 << 16), 0.25)
    texts = ["one two three", "", "x", "ab", "Éclair été " * 50, "one two three"]
    data, offsets = texts_block(texts)
    scores = model.scores(data, offsets)
    for text, (buckets, weights), score in zip(texts, document_features(data, offsets), scores):
        logit = float(weights @ model.bucket_scores[buckets]) + 0.25
        assert score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-5)
    assert scores[0] == pytest.approx(scores[5], abs=1e-12)
    alone = model.scores(*texts_block([texts[4]]))
    assert alone[0] == pytest.approx(scores[4], abs=1e-12)
    assert len(list(feature_groups(data, offsets))) == 4


def test_no_examples_and_one_class():
    assert train([]).scores(*texts_block(["a"]))[0] == 0.5
    example = [(np.array([3], np.int32), np.array([1.0], np.float32), 1)]
    assert train(example).scores(*texts_block(["a"]))[0] > 0.5


def test_odd_rows(spark, make_docs):
    docs = make_docs([(k, t) for k, t in enumerate(TEXTS)] + [(None, "x y"), (2, TEXTS[2])])
    labels = spark.createDataFrame([(3, 0), (5, 1), (3, 0), (None, 1), (7, None), (99, 1)], "doc_id long, label int")
    model = train(training_examples(docs, labels))
    found = score_documents(docs, model).collect()
    assert len(found) == len(TEXTS) + 2
    by_id = {row["doc_id"]: row["score"] for row in found}
    assert by_id[0] == by_id[1] and all(0 <= row["score"] <= 1 for row in found)
    # Three labelled rows teach the order, not the scale.
    assert by_id[5] > by_id[3]
    assert score_documents(make_docs([]), model).count() == 0


def test_held_out_accuracy(spark):
    from corpusloom.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    found = QUERIES["op7_quality_classifier"](spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    right = sum(row["predicted"] == row["quality"] for row in found)
    assert right >= 0.93 * len(found)
    clean = [row["predicted"] for row in found if row["quality"] == 1]
    assert sum(clean) >= 0.95 * len(clean)
