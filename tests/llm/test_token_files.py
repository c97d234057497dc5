import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import token_files
from corpusloom.llm.token_files import (
    IdReader,
    IdWriter,
    WordEncoder,
    decode_block,
    encode_block,
    read_token_files,
    write_token_files,
)

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(5, 20), min_size=1, max_size=300))
@settings(max_examples=200, deadline=None)
def test_blocks_round_trip(ids):
    ids = np.array(ids, "<u4")
    assert np.array_equal(decode_block(encode_block(ids)), ids)


def test_outliers_go_to_the_exception_list():
    ids = np.full(6400, 1000, "<u4")
    ids += np.arange(6400, dtype="<u4") % 16
    plain = len(encode_block(ids))
    ids[[7, 4000]] = 2**31
    assert len(encode_block(ids)) == plain + 2 * 8  # the width stays at four bits
    assert plain < 6400 * 0.51


def test_file_seeks_and_reads_documents(tmp_path):
    random = np.random.default_rng(0)
    docs = [(k, random.integers(0, 50_000, n).astype("<u4")) for k, n in enumerate([1, 0, 70_000, 3, 200_000])]
    docs.append((None, np.array([5], "<u4")))
    writer = IdWriter(str(tmp_path / "a" / "ids.pfor"))
    for key, ids in docs:
        writer.add(key, ids)
    writer.close()
    reader = IdReader(writer.uri)
    everything = np.concatenate([ids for _, ids in docs])
    assert np.array_equal(reader.ids(69_990, 90_001), everything[69_990:90_001])
    found = list(reader.documents())
    assert [key for key, _, _ in found] == [key for key, _ in docs]
    assert all(np.array_equal(a, b) for (_, _, a), (_, b) in zip(found, docs))
    (tmp_path / "bad").write_bytes(b"short")
    with pytest.raises(ValueError):
        IdReader(str(tmp_path / "bad"))


TEXTS = [
    "It's <|endoftext|> foo\x1cbar x\u0301 \u0130stanbul, don't 12ab can\u2019t go--now. \ufb01sh",
    "Word### word, WORD! (word) \u03a3\u03b1\u03c2 \u01c5x Stra\u00dfe. _x_ a_b |",
    "",
    "  \n\t ",
]


def test_words_encode_as_the_library_does():
    library, own = Tokenizer.from_file(PATH), WordEncoder(PATH)
    for text in TEXTS * 2:
        assert own.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text_encodes_as_the_library_does(text):
    library, own = WordEncoder.of(PATH).tokenizer, WordEncoder.of(PATH)
    assert own.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_documents_in_order(spark, make_docs, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 50)
    rows = [(k * 3 % 17, t) for k, t in enumerate(TEXTS * 4)] + [(5, None), (5, "again"), (None, "no id")]
    library = Tokenizer.from_file(PATH)
    manifest = write_token_files(make_docs(rows), PATH, end_id=1)
    found = read_token_files(manifest).collect()
    found.sort(key=lambda row: row["start"])
    start = 0
    expected = {}
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        expected.setdefault(key, []).append(tuple(ids))
    got = {}
    for row in found:
        ids = tuple(np.frombuffer(row["ids"], "<u4").tolist())
        assert row["start"] == start
        start += len(ids)
        got.setdefault(row["doc_id"], []).append(ids)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    keys = [row["doc_id"] for row in found]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])


def test_empty_table(make_docs):
    manifest = write_token_files(make_docs([]), PATH, end_id=1)
    assert manifest.count() == 0 and read_token_files(manifest).count() == 0
