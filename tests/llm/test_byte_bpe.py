import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import byte_bpe
from corpusloom.llm.byte_bpe import decode_documents, encode_documents, encoder, safe_pieces

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def test_ids_and_bytes_of_odd_texts(make_docs):
    texts = ["", None, "It's  a\n\n test 123", "é" * 40_000, "ab " * 150_000, " " * 9, "<|endoftext|>"]
    docs = make_docs([(k, t) for k, t in enumerate(texts)] + [(2, texts[2]), (None, "x")])
    rows = decode_documents(encode_documents(docs, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert len(rows) == len(texts) + 2
    own = encoder(RANKS, PATTERN)
    for row in rows:
        ids = np.frombuffer(row["token_ids"], "<u4").tolist()
        assert ids == own.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
    assert rows[0]["n_words"] == -1  # the other columns are as they were


def test_empty_table_and_replaced_column(spark):
    empty = spark.createDataFrame([], "text string, token_ids int")
    found = encode_documents(empty, RANKS, PATTERN)
    assert found.columns == ["text", "token_ids"] and found.count() == 0


def test_null_ids_stay_null(spark):
    rows = spark.createDataFrame([(None,)], "token_ids binary")
    assert decode_documents(rows, RANKS, PATTERN).first()["decoded"] is None


@given(st.text(alphabet="ab' \n\tsé1.", max_size=200))
@settings(max_examples=300, deadline=None)
def test_pieces_encode_as_the_whole(text):
    pieces = list(safe_pieces(text, 5))
    assert "".join(pieces) == text
    own = encoder(RANKS, PATTERN)
    assert [i for p in pieces for i in own.encode_ordinary(p)] == own.encode_ordinary(text)


def test_query_digests(spark):
    from corpusloom.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op4_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    own = byte_bpe.encoder(RANKS, PATTERN)
    for row in rows:
        ids = own.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
