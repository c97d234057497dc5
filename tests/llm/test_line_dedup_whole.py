"""Line deduplication compared with all character shingles of all lines."""

import random
import re
from collections import Counter

from corpusloom.llm import line_dedup
from corpusloom.llm.line_dedup import dedup_lines


def shingle_set(line):
    return {line[k : k + 12] for k in range(max(1, len(line) - 11))}


def kept_lines(lines):
    """Lines that stay of single-line documents in normal form, comparing all pairs."""
    sets = [shingle_set(line) for line in lines]
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [k for k in range(len(lines)) if find(k) == k]


def kept_by_operator(make_docs, lines):
    found = dedup_lines(make_docs(list(enumerate(lines)))).collect()
    return sorted(row["doc_id"] for row in found if row["n_removed_lines"] == 0)


def test_shingles_have_twelve_characters():
    assert line_dedup.SHINGLE_CHARS == 12


def test_characters_after_a_words_beginning_count(make_docs):
    rng = random.Random(3)
    links = lambda: " ".join(f"https://www.example.com/{rng.getrandbits(40)}" for _ in range(5))
    lines = [links() for _ in range(6)]
    run = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(120))
    lines += ["a b c d " + run, "a b c d " + run[:60] + "x" + run[61:], "a b c d " + run[:16] + run[::-1]]
    lines += ["a b c d \U0001f600" + run[::2], "A  b c d \U0001f600" + run[::2]]
    normal = [" ".join(line.lower().split()) for line in lines]
    expected = kept_lines(normal)
    assert expected == [*range(7), 8, 9]
    assert kept_by_operator(make_docs, lines) == expected


def test_unspaced_and_short_lines_are_judged(make_docs):
    rng = random.Random(4)
    run = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(300))
    lines = [run, run, run[:150] + "x" + run[151:], run[::-1], "And ornd.", "and  ornd.", "And ornd!"]
    assert kept_by_operator(make_docs, lines) == [0, 3, 4, 6]


def test_near_copies_over_a_shared_template(make_docs):
    rng = random.Random(5)
    prose = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    template = "t" + prose(300)
    lines = []
    for number in range(60):
        own = f"{number:02}" + prose(98)
        lines += [template + own + "x", template + own[:60] + "q" + own[61:] + "x"]
    lines = [" ".join(line.split()) for line in lines]
    expected = kept_lines(lines)
    assert expected == list(range(0, 120, 2))
    assert kept_by_operator(make_docs, lines) == expected


def test_all_lines_of_a_bucket_are_compared(make_docs, monkeypatch):
    # One bucket of lines that differ from its first; what is compared has no bound.
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 7, raising=False)
    monkeypatch.setattr(line_dedup, "SEARCHES", 1, raising=False)
    monkeypatch.setattr(line_dedup, "LEADERS", 1, raising=False)
    rng = random.Random(6)
    prose = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    template = prose(300)
    lines = []
    for _ in range(90):
        own = prose(115)
        lines += [template + own, template + own[:50] + "q" + own[51:90] + "q" + own[91:]]
    expected = kept_lines(lines)
    assert expected == list(range(0, 180, 2))
    assert kept_by_operator(make_docs, lines) == expected


def near_copies(count):
    """Lines with one or two changed characters: of those with two, few link directly."""
    rng = random.Random(7)
    base = "".join(rng.choice("abcdefghijklmnop") for _ in range(300))
    lines = []
    for number in range(count):
        line = list(base)
        for at in rng.sample(range(20, 280), 1 + (number % 3 > 0)):
            line[at] = "z"
        lines.append("".join(line))
    return lines


def test_pairs_of_near_copies_do_not_grow_with_their_square(make_docs, monkeypatch):
    made, rest = [], line_dedup._rest

    def counted(*args):
        pairs = rest(*args)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(line_dedup, "_rest", counted)
    lines = near_copies(240)
    assert kept_by_operator(make_docs, lines) == kept_lines(lines)
    assert made[0] < len(lines)


def test_lines_too_many_to_send_are_compared_in_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 7)
    monkeypatch.setattr(line_dedup, "HUBS", 1)
    monkeypatch.setattr(line_dedup, "broadcast_if_bounded", lambda df, *args, **more: (df, False))
    lines = near_copies(60)
    assert kept_by_operator(make_docs, lines) == kept_lines(lines)


def test_recall_on_a_whole_table(spark):
    """Removed lines of all documents of sf0.01 against all pairs that share a shingle."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    lines, places = {}, []
    for key, text in sorted(docs.where("text is not null").collect()):
        for place, raw in enumerate(text.split("\n")):
            line = re.sub(r"[\x20\x09-\x0D]+", " ", raw.lower()).strip(" ")
            if line:
                places.append((key, place, lines.setdefault(line, len(lines))))
    sets = [shingle_set(line) for line in lines]
    holders = {}
    for n, of_line in enumerate(sets):
        for shingle in of_line:
            holders.setdefault(shingle, []).append(n)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for n, of_line in enumerate(sets):
        shared = Counter(m for shingle in of_line for m in holders[shingle] if m < n)
        for m, both in shared.items():
            if 100 * both >= 75 * (len(of_line) + len(sets[m]) - both):
                root[find(n)] = find(m)
    first, expected = {}, set()
    for key, place, n in places:
        if first.setdefault(find(n), (key, place)) != (key, place):
            expected.add((key, place))
    gone = Counter(key for key, _ in expected)
    found = dict(dedup_lines(docs).select("doc_id", "n_removed_lines").collect())
    # Nothing is removed that is not similar, and nearly all is found that is.
    assert all(n <= gone[key] for key, n in found.items())
    assert sum(found.values()) >= 0.98 * len(expected)
