import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm.chat import Reader, Template, TurnOrder, format_conversations, read_back

SCHEMA = "conv_id long, turn long, role string, text string, loss int"


def test_escape_is_reversible_and_framed():
    template = Template()

    @given(st.lists(st.tuples(st.sampled_from(["user", "a: b", "x\\", ""]), st.text(alphabet="\\#</turn> \n:é", max_size=40)), max_size=5))
    @settings(max_examples=400, deadline=None)
    def check(turns):
        text = ""
        for role, said in turns:
            opening = template.before.replace("{role}", template.name(role))
            text += opening + template.escape(said) + template.after
        reader = Reader(template)
        assert list(reader.feed(text)) == turns and not reader.left

    check()


def test_order_of_turns():
    def run(*roles):
        order = TurnOrder(Template())
        return [order.step(role) for role in roles]

    assert run("system", "user", "assistant", "user") == [True] * 4
    assert run("assistant", "user") == [False, False]
    assert run("user", "user", "assistant") == [True, False, False]
    assert run("user", "tool") == [True, False]


def test_odd_rows(spark, collect):
    said = r"\### Assistant: </turn> ok"
    rows = [
        (1, 0, "user", said, 7),
        (1, 1, "assistant", said, 7),
        (2, 1, "assistant", None, 7),
        (2, 0, None, "first", 7),
        (3, None, "user", "no turn", 7),
        (3, 0, "user", "", 7),
        (3, 0, "user", "", 7),
        (None, 0, "user", "x" * 3_000_000, 7),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {row["conv_id"]: row for row in read_back(format_conversations(df)).collect()}
    assert len(found) == 4

    def digest(*turns):
        return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()

    assert found[1]["turns_sha256"] == digest(("user", said), ("assistant", said))
    assert found[1]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert found[1]["loss_chars"] == len(said) and found[1]["valid"]
    assert found[2]["turns_sha256"] == digest(("", "first"), ("assistant", ""))
    assert not found[2]["valid"] and found[2]["loss_chars"] == 0
    assert found[3]["n_turns"] == 3 and not found[3]["valid"]
    assert found[None]["turns_sha256"] == digest(("user", "x" * 3_000_000))
    segments = format_conversations(df).where("conv_id = 1").collect()
    assert [s["segment"] for s in segments] == ["open", "body", "close"] * 2
    assert [s["loss"] for s in segments] == [False] * 4 + [True, False]


def test_empty_table(spark):
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
