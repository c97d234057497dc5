import random

import numpy as np
import pytest

from corpusloom.llm import repeated_strings as module
from corpusloom.llm.repeated_strings import (
    anchors,
    common_prefixes,
    cut_spans,
    remove_repeated,
    smaller_than_successor,
    suffix_array,
)


def test_suffix_arrays_against_sorting():
    rng = np.random.default_rng(1)
    for turn in range(150):
        data = rng.integers(0, rng.integers(1, 5), int(rng.integers(1, 400))).astype(np.uint8) + 97
        text = data.tobytes()
        order = suffix_array(data, 400)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        small = smaller_than_successor(data)
        assert small.tolist() == [text[i:] < text[i + 1 :] for i in range(len(text))]
        shared = common_prefixes(data, order, 50)
        for k in range(1, len(order)):
            a, b = text[order[k - 1] :], text[order[k] :]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[k] == min(n, 50)


def test_anchors_of_equal_strings_are_equal():
    random.seed(5)
    shared = bytes(random.choices(b"abcd ", k=300))
    texts = [bytes(random.choices(b"abcd ", k=random.randrange(150))) + shared for _ in range(5)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    text, low, n, gram, context = anchors(data, offsets)
    # Every string has one anchor.
    assert sum(n) == sum(len(t) - 99 for t in texts)
    of_string = {}
    for t, start, count, g in zip(text, low, n, gram):
        for k in range(count):
            of_string.setdefault(texts[t][start + k : start + k + 100], set()).add(int(g))
    assert all(len(found) == 1 for found in of_string.values())


def brute(rows, length=100):
    seen, marks = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    out = [None] * len(rows)
    for i in order:
        key, text = rows[i]
        data = (text or "").encode()
        mark = bytearray(len(data))
        for p in range(len(data) - length + 1):
            at = seen.setdefault(data[p : p + length], (key, p))
            if at != (key, p):
                mark[p : p + length] = b"\1" * length
        marks.append(mark)
        kept = bytes(b for b, m in zip(data, mark) if not m)
        runs = sum(m and not (k and mark[k - 1]) for k, m in enumerate(mark))
        out[i] = (key, len(data), sum(mark), runs, kept)
    return out


def check(make_docs, rows, collect):
    found = [(*row[:4], bytes(row[4])) for row in remove_repeated(make_docs(rows)).collect()]
    key = lambda row: (row[0] is not None, row[0] or 0, row[4])
    assert sorted(found, key=key) == sorted(brute(rows), key=key)


def corpus(seed, n=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcé", k=rng.randrange(1, 6)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(40) for _ in range(3)]
    rows = []
    for k in range(n):
        parts = [prose(rng.randrange(60)) for _ in range(2)]
        if rng.random() < 0.7:
            parts.insert(1, rng.choice(passages))
        rows.append((k, " ".join(parts)))
    rows += [(n, rows[3][1]), (n + 1, rows[3][1][:-7]), (n + 2, rows[5][1].replace("a", "b", 1))]
    return rows


def test_against_brute_force(make_docs, collect):
    rows = corpus(2) + [
        (None, passage := "no id " * 40),
        (900, passage),
        (901, "a" * 1000),
        (902, "ab" * 99),
        (903, None),
        (904, ""),
        (905, "short"),
        (-5, corpus(2)[0][1]),
        (906, "".join(chr(97 + k * k % 23) for k in range(30_000))),
    ]
    check(make_docs, rows, collect)


def test_hot_grams_and_small_arrays(make_docs, collect, monkeypatch):
    monkeypatch.setattr(module, "HOT_SAMPLE", 1)
    monkeypatch.setattr(module, "HOT_LEAST", 3)
    monkeypatch.setattr(module, "HOT_SALTS", 5)
    monkeypatch.setattr(module, "ARRAY_BYTES", 400)
    check(make_docs, corpus(7), collect)


def test_repeated_rows_do_not_repeat_each_other(make_docs, collect):
    text = corpus(1)[0][1] + "x" * 120
    found = remove_repeated(make_docs([(1, text), (1, text), (2, text)])).collect()
    assert sorted((row[0], row[2]) for row in found)[:2] == sorted((row[0], row[2]) for row in found if row[0] == 1)
    assert {row[2] for row in found if row[0] == 1} == {brute([(1, text)])[0][2]}
    assert {row[2] for row in found if row[0] == 2} == {len(text.encode())}


def test_empty_table(make_docs):
    assert remove_repeated(make_docs([])).count() == 0


@pytest.mark.parametrize(
    "spans, result",
    [([], (b"abcdef", 0, 0)), ([(0, 2), (2, 4)], (b"ef", 4, 1)), ([(1, 3), (2, 9)], (b"a", 5, 1)), ([(9, 12)], (b"abcdef", 0, 0))],
)
def test_cutting(spans, result):
    assert cut_spans(b"abcdef", spans) == result
