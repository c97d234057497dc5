import random
import re

import numpy as np

from corpusloom.llm import jaccard_join as module
from corpusloom.llm.components import connected_components
from corpusloom.llm.jaccard_join import (
    GROUPS,
    CountTree,
    may_link,
    prefix_lengths,
    shingle_sets,
    similar_documents,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(5)]))


def brute(rows):
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(key)
    smallest = {g: min((k for k in keys if k is not None), default=None) for g, keys in groups.items()}
    return sorted(
        ((key, len(sets[i]), smallest[find(i)]) for i, (key, _) in enumerate(rows)), key=str
    )


def check(make_docs, rows):
    found = similar_documents(make_docs(rows)).collect()
    assert sorted(((r[0], r[1], r[2]) for r in found), key=str) == brute(rows)


def near_copies(seed, n=60):
    rng = random.Random(seed)
    prose = lambda k: [f"w{rng.randrange(3000)}" for _ in range(k)]
    rows = []
    for _ in range(n // 6):
        words = prose(rng.randrange(6, 120))
        for _ in range(6):
            copy = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                copy[rng.randrange(len(copy))] = "changed%d" % rng.randrange(99)
            rows.append((len(rows), " ".join(copy[rng.randrange(4) :])))
    return rows


ODD = [
    (500, None),
    (501, ""),
    (502, " \n "),
    (503, "One two"),
    (504, "one TWO"),
    (505, "one two three"),
    (506, "a b c d e"),
    (507, "A b c d e"),
    (508, "É b c d e"),
    (-3, "one two"),
    (503, "One two"),
    (None, "a b c d e"),
    (None, "nobody else says this at all"),
    (509, "long " + " ".join(f"x{i * i}" for i in range(20_000))),
    (510, "long " + " ".join(f"x{i * i}" for i in range(20_050))),
    (511, "the same words again and again " * 50),
    (512, "the same words again and again " * 70),
]


def test_against_brute_force(make_docs):
    check(make_docs, near_copies(1) + ODD)


def test_shared_passage_and_common_shingles(make_docs, monkeypatch):
    monkeypatch.setattr(module, "COMMON_SAMPLE", 1)
    monkeypatch.setattr(module, "COMMON_LEAST", 4)
    monkeypatch.setattr(module, "BUCKET_ROWS", 3)
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = near_copies(9, 36)
    rows += [(700 + k, passage + " " + " ".join(f"q{rng.randrange(9**6)}" for _ in range(rng.randrange(4, 40)))) for k in range(40)]
    check(make_docs, rows)


def test_bucket_of_many_components(make_docs, monkeypatch):
    """No two of them link, but all share the shingles of one passage, in blocks of three."""
    monkeypatch.setattr(module, "BUCKET_ROWS", 3)
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(60))
    own = lambda: " ".join(f"q{rng.randrange(9**7)}" for _ in range(14))
    rows = [(k, f"{passage} {own()}") for k in range(40)]
    rows += [(100 + k, text + " more") for k, (_, text) in enumerate(rows[::4])]
    check(make_docs, rows)


def test_lone_members_beside_a_large_component(spark, make_docs, monkeypatch):
    """The best pair between two components joins them; the pairs left are searched then."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(80)]
    rows = []
    for k in range(120):
        copy = list(words)
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(80)] = f"x{rng.randrange(9**6)}"
        rows.append((k, " ".join(copy)))
    verified = []
    plain = module._verified

    def counted(texts, classes, pairs):
        verified.append(pairs.count())
        return plain(texts, classes, pairs)

    monkeypatch.setattr(module, "_verified", counted)
    check(make_docs, rows)
    assert sum(verified) < 120 * 119 / 8


def test_bucket_rows_of_small_batches(spark, make_docs):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        check(make_docs, near_copies(3))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_empty_table(make_docs):
    assert similar_documents(make_docs([])).count() == 0


def test_prefixes_of_linked_sets_meet():
    rng = random.Random(0)
    for _ in range(300):
        a = set(rng.sample(range(60), rng.randrange(1, 40)))
        b = set(x for x in a if rng.random() < 0.9) | set(rng.sample(range(60), rng.randrange(3)))
        if not b or not may_link(len(a & b), len(a), len(b)):
            continue
        first = [set(sorted(s)[: int(prefix_lengths(np.array([len(s)]))[0])]) for s in (a, b)]
        assert first[0] & first[1]


def test_tree_finds_all_admitted_pairs():
    rng = np.random.default_rng(0)
    for _ in range(30):
        m = int(rng.integers(1, 300))
        base = rng.poisson(3, (5, GROUPS))
        moved = base[rng.integers(0, 5, m)] + rng.integers(-1, 2, (m, GROUPS)) * (rng.random((m, GROUPS)) < 0.3)
        points = np.maximum(moved, 0).astype(np.uint8)
        sizes, labels = points.sum(axis=1).astype(np.int64), rng.integers(0, 6, m)
        got = [p for a, b in CountTree(points, sizes).pairs(labels) for p in zip(a.tolist(), b.tolist())]
        got = sorted(tuple(sorted(p)) for p in got)
        bound = lambda i, j: int(np.minimum(points[i], points[j]).astype(int).sum())
        assert got == [
            (i, j)
            for i in range(m)
            for j in range(i + 1, m)
            if labels[i] != labels[j] and may_link(bound(i, j), int(sizes[i]), int(sizes[j]))
        ]


def test_sets_do_not_cross_texts():
    texts = ["a b c d e f", "", "g h", "a b c d e f"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    hashes, first = shingle_sets(data, offsets)
    assert np.diff(first).tolist() == [2, 0, 1, 2]
    assert hashes[first[0] : first[1]].tolist() == hashes[first[3] : first[4]].tolist()


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (201, 200), (200, 201), (None, 3)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)} | {200: 200, 201: 200}
    assert len(found) == len(expected) and {r["node"]: r["root"] for r in found} == expected
    empty = connected_components(spark.createDataFrame([], "a long, b long"))
    assert empty.count() == 0
