from random import Random

from corpusloom.llm.decontamination import (
    LITERAL,
    NAME,
    NUMBER,
    UNIT,
    TemplateIndex,
    Tokens,
    contaminated,
    find_leaks,
)

ITEM = "A farmer has 12 apples and gives 5 kg of them to Bob while Anna keeps 12 pears in the old red barn"
OTHER = "Which of these rivers runs through the largest number of different countries on its way to the sea"


def kinds(text):
    return Tokens([text]).kinds.tolist()


def test_kinds_of_tokens():
    assert kinds("It weighs 12.5 kg, said Bob. Anna left") == [LITERAL, LITERAL, NUMBER, UNIT, LITERAL, NAME, LITERAL, LITERAL]
    assert kinds("kg 3 Kg") == [LITERAL, NUMBER, UNIT]
    assert kinds("say NATO and Élan\nThen") == [LITERAL, LITERAL, LITERAL, NAME, LITERAL]
    assert kinds(" -- ?! ") == []
    two = Tokens(["ends with 7", "km begins", "", None or "x"])
    assert two.kinds.tolist() == [LITERAL, LITERAL, NUMBER, LITERAL, LITERAL, LITERAL]
    assert two.first.tolist() == [0, 3, 5, 5, 6]


def leaks(*texts, items=((1, ITEM), (2, OTHER))):
    return list(find_leaks(list(texts), TemplateIndex(list(items))))


def test_exact_and_changed_questions():
    changed = ITEM.replace("12", "30").replace("5 kg", "8 lb").replace("Bob", "Carl").replace("Anna", "Dora")
    assert [row[:3] for row in leaks("Before. " + ITEM + " after", changed, "x " + OTHER.upper())] == [
        (0, 1, "exact"),
        (1, 1, "template"),
        (2, 2, "exact"),
    ]


def test_inconsistent_slots_are_no_leak():
    changed = ITEM.replace("12", "30", 1).replace("12", "31").replace("Bob", "Carl").replace("5", "6")
    assert leaks(changed) == []
    same_name = ITEM.replace("Bob", "Carl").replace("Anna", "Carl").replace("5", "6").replace("12", "13")
    assert leaks(same_name) == []


TOM = "Tom has 3 apples. Ann buys 4 more pears today. Tom sells 2 to the shop."


def test_names_that_open_sentences():
    changed = [
        TOM.replace("Ann", "Eve"),
        TOM.replace("Tom", "Max").replace("3", "8").replace("4", "9").replace("2", "6"),
        "So it goes: " + TOM.replace("Ann", "Eve").replace("3", "31"),
    ]
    assert [row[:3] for row in leaks(*changed, items=[(5, TOM)])] == [(k, 5, "template") for k in range(3)]
    # One name for two, and two for one.
    assert leaks(TOM.replace("Ann", "Tom"), TOM.replace("Tom", "Max", 1).replace("Ann", "Max"), items=[(5, TOM)]) == []
    # A function word is not a name.
    question = TOM.replace("Ann", "She")
    assert leaks(question.replace("She", "Eve"), items=[(5, question)]) == []


def test_items_of_mostly_slots():
    item = "Compute 12 + 34 - 56"
    assert [row[:3] for row in leaks("Compute 77 + 31 - 5", item, items=[(1, item)])] == [(0, 1, "template"), (1, 1, "exact")]
    assert leaks("Compute 77 + 77 - 5", "Divide 77 + 31 - 5", "77 + 31 - 5", items=[(1, item)]) == []
    long = "Add 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 up"
    other = "Add " + " ".join(str(k) for k in range(101, 116))
    assert [row[:2] for row in leaks(other + " up", other + " down", items=[(1, long)])] == [(0, 1)]


def by_brute_force(text, items, window=13):
    """Items with a window that agrees with the text, by all alignments of both."""
    found = set()
    mine = Tokens([text])
    words = [mine.word(k) for k in range(len(mine.starts))]
    for key, item in items:
        own = Tokens([item])
        asked = [own.word(k) for k in range(len(own.starts))]
        n = len(asked)
        spans = [(i, i + window) for i in range(n - window + 1)] if n > window else [(0, n), (1, n)]
        spans = [(a, b) for a, b in spans if b > a]
        for shift in range(-n, len(words)):
            for my_kinds, kinds in ((mine.kinds, own.kinds), (mine.loose, own.loose)):

                def agrees(a, b):
                    if shift + a < 0 or shift + b > len(words):
                        return False
                    return all(
                        words[shift + k] == asked[k] or (kinds[k] != LITERAL and my_kinds[shift + k] == kinds[k])
                        for k in range(a, b)
                    )

                def one_to_one(ranges):
                    pairs = {(asked[k], words[shift + k]) for a, b in ranges for k in range(a, b) if kinds[k] != LITERAL}
                    return len(pairs) == len({x for x, _ in pairs}) == len({y for _, y in pairs})

                good = [(a, b) for a, b in spans if agrees(a, b)]
                if any(words[shift + a : shift + b] == asked[a:b] for a, b in good):
                    found.add(key)
                rich = [(a, b) for a, b in good if 2 * sum(kinds[a:b] == LITERAL) >= b - a]
                telling = [
                    (a, b) for a, b in good
                    if n >= 4 and any(kinds[k] == LITERAL and not own.function[k] for k in range(a, b))
                ]
                if rich and one_to_one({*rich, *telling}):
                    found.add(key)
                if telling and agrees(0, n) and one_to_one([(0, n)]):
                    found.add(key)
    return found


def test_against_brute_force():
    random = Random(7)
    names, words = ["Tom", "Ann", "Eve", "The"], ["has", "buys", "kg", "apples", "of", "NATO"]

    def sentence(n):
        parts = [random.choice(random.choice([names, words, words, ["3", "4", "15"]])) for _ in range(n)]
        return " ".join(part + random.choice(["", "", "", ".", "\n"]) for part in parts)

    items = [(k, sentence(random.choice([1, 2, 4, 6, 13, 15, 20]))) for k in range(40)]
    swaps = [("Tom", "Max"), ("Ann", "Eve"), ("3", "8"), ("4", "15"), ("has", "sells")]
    texts = []
    for _, item in items:
        text = item
        for old, new in random.sample(swaps, random.randrange(4)):
            text = text.replace(old, new, random.choice([1, 9]))
        texts.append(sentence(3) + " " + text + " " + sentence(random.randrange(5)))
    found = {(doc, key) for doc, key, _, _ in leaks(*texts, items=items)}
    wanted = {(doc, key) for doc, text in enumerate(texts) for key in by_brute_force(text, items)}
    assert found == wanted and 20 < len({doc for doc, _ in wanted})


def test_clean_and_odd_texts():
    assert leaks("", "the cat", " ".join(OTHER.split()[:12]), "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15") == []
    assert leaks("x", items=[(1, ""), (2, "!!"), (3, "1 2 3")]) == []
    assert [row[:2] for row in leaks("say the short item now", items=[(1, "The short item")])] == [(0, 1)]
    long = "filler " * 200_000 + OTHER
    assert [row[:2] for row in leaks(long)] == [(0, 2)]
    # A window does not reach over the end of a text.
    words = OTHER.split()
    assert leaks(" ".join(words[:9]), " ".join(words[9:])) == []


def test_pairs_of_documents_and_items(spark, make_docs):
    docs = make_docs([(1, ITEM), (2, OTHER + "\n" + ITEM), (3, None), (4, ""), (5, "clean text"), (1, ITEM), (None, OTHER)])
    schema = "item_id long, text string, doc_id int"
    items = spark.createDataFrame([(1, ITEM, 0), (2, OTHER, 0), (3, None, 0), (4, "", 0), (2, OTHER, 0)], schema)
    expected = [(1, 1), (2, 1), (2, 2), (None, 2)]
    for size in (1 << 20, 60):  # one pass and several
        found = contaminated(docs, items, pass_bytes=size).collect()
        assert sorted(((r["doc_id"], r["item_id"]) for r in found), key=str) == sorted(expected, key=str)
        assert all(r["kind"] == "exact" and r["n_windows"] > 0 for r in found)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(make_docs([(1, ITEM)]), none).count() == 0
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert contaminated(make_docs([]), items).count() == 0


def test_query_finds_planted_items(spark):
    from corpusloom.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    flat = lambda text: " ".join(text.split())
    planted = {(d[0], i["item_id"]) for d in docs for i in items if flat(i["text"]) in flat(d[1])}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op5_decontamination"](spark, sf_dir).collect()}
    assert planted and planted <= found
