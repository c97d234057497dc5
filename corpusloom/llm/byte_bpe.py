"""Byte-level BPE encoding and decoding with a local rank file."""

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters after which a long text is cut at the next safe boundary.
PIECE_CHARS = 1 << 18


@lru_cache(maxsize=4)
def encoder(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file; one per worker and file."""
    with open(ranks_path, "rb") as lines:
        ranks = {
            base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in lines if line.strip())
        }
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = PIECE_CHARS):
    """Cut a text where no match of the split pattern can cross.

    A boundary stands before a single ASCII space that has a character other than
    white space on both sides: a match may begin with such a space, never go on
    through it. A stretch without a boundary stays whole.
    """
    start, n = 0, len(text)
    while n - start > size:
        at = text.find(" ", start + size)
        while 0 < at < n - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if not 0 < at < n - 1:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def _to_binary(rows) -> pa.Array:
    return pa.array(rows, pa.binary())


def encode_ids(text: Column, ranks_path: str, pattern: str) -> Column:
    """Token ids of each text as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded by itself and special tokens are plain
    text. A null text gives no ids (an empty value), as an empty text does.
    """

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        encoding = encoder(ranks_path, pattern)
        rows = []
        for text in texts:
            ids: list[int] = []
            for piece in safe_pieces(text.as_py() or ""):
                ids += encoding.encode_ordinary(piece)
            rows.append(np.array(ids, dtype="<u4").tobytes())
        return _to_binary(rows)

    return encode(text)


def decode_ids(ids: Column, ranks_path: str, pattern: str) -> Column:
    """The raw bytes of token ids as made by :func:`encode_ids`; null stays null.

    The bytes need not be valid UTF-8. An id outside the vocabulary fails the task.
    """

    @F.arrow_udf("binary")
    def decode(rows: pa.Array) -> pa.Array:
        encoding = encoder(ranks_path, pattern)
        return _to_binary(
            [
                encoding.decode_bytes(np.frombuffer(row.as_py(), dtype="<u4").tolist())
                if row.is_valid
                else None
                for row in rows
            ]
        )

    return decode(ids)


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", into: str = "token_ids"
) -> DataFrame:
    """``docs`` with a column of token ids, without a shuffle.

    Every row is kept with all its columns, repeated rows and rows with a null id
    as well; a column that has the name ``into`` is replaced.
    """
    return docs.withColumn(into, encode_ids(F.col(text_col), ranks_path, pattern))


def decode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    ids_col: str = "token_ids",
    into: str = "decoded",
) -> DataFrame:
    """``docs`` with the bytes that the ids of ``ids_col`` stand for."""
    return docs.withColumn(into, decode_ids(F.col(ids_col), ranks_path, pattern))
