"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of successive documents, cut into blocks of ``BLOCK_IDS``. A
block stores its minimum and the differences from it, packed at the width that a
percentile of them needs; larger differences go to an exception list. A footer
lists the start of each block and the id and length of each document, so that a
reader can fetch any run of ids without decoding the file.

    magic | block ... | footer arrays | counts | magic
    block: minimum u4, ids u4, exceptions u4, width u4 | packed words u8 |
           places u4 | differences u4
    footer: block starts u8 | document ids i8 | null flags u1 | lengths u8
    counts: blocks, documents, ids, start of the footer (u8 each)
"""

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import work_path, work_table
from .files import attempt_name, open_input, open_output

MAGIC = b"PFORIDS1"
BLOCK_IDS = 1 << 14
#: A file is closed at the first document end after so many ids.
FILE_IDS = 1 << 26
#: Share of a block's differences that the packed width must hold, in percent.
WIDTH_PERCENTILE = 99.0
#: Words whose ids a worker remembers; the memory is emptied when it is full.
REMEMBERED_WORDS = 1_000_000

_BLOCK_HEAD = struct.Struct("<IIII")
_COUNTS = struct.Struct("<QQQQ")
# Letters of the Latin alphabets up to U+024F, and ASCII punctuation after them.
_LETTERS = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\\[-`{-~]*)")
# Controls that Python's split takes for white space and the tokenizer does not.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Values below ``2**width`` as 64-bit words; 64 values take ``width`` words."""
    lanes = np.zeros((-(-len(values) // 64), 64), dtype=np.uint64)
    lanes.reshape(-1)[: len(values)] = values
    words = np.zeros((len(lanes), width), dtype=np.uint64)
    for lane in range(64 if width else 0):
        word, shift = divmod(lane * width, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.reshape(-1)


def unpack_bits(words: np.ndarray, width: int, count: int) -> np.ndarray:
    """The ``count`` values that :func:`pack_bits` packed at ``width``."""
    if not width:
        return np.zeros(count, dtype=np.uint64)
    words = words.reshape(-1, width)
    lanes = np.empty((len(words), 64), dtype=np.uint64)
    mask = np.uint64((1 << width) - 1)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        lanes[:, lane] = value & mask
    return lanes.reshape(-1)[:count]


def encode_block(ids: np.ndarray, percentile: float = WIDTH_PERCENTILE) -> bytes:
    """One block of unsigned 32-bit ids."""
    minimum = int(ids.min())
    rest = ids.astype(np.uint64) - np.uint64(minimum)
    rank = min(len(rest) - 1, int(len(rest) * percentile / 100))
    width = int(np.partition(rest, rank)[rank]).bit_length()
    places = np.flatnonzero(rest >> np.uint64(width))
    large = rest[places].astype("<u4")
    rest[places] = 0
    return b"".join(
        (
            _BLOCK_HEAD.pack(minimum, len(ids), len(places), width),
            pack_bits(rest, width).astype("<u8").tobytes(),
            places.astype("<u4").tobytes(),
            large.tobytes(),
        )
    )


def decode_block(data: bytes) -> np.ndarray:
    minimum, count, n_large, width = _BLOCK_HEAD.unpack_from(data)
    n_words = -(-count // 64) * width
    at = _BLOCK_HEAD.size
    values = unpack_bits(np.frombuffer(data, "<u8", n_words, at), width, count)
    at += 8 * n_words
    places = np.frombuffer(data, "<u4", n_large, at)
    values[places] = np.frombuffer(data, "<u4", n_large, at + 4 * n_large)
    return (values + np.uint64(minimum)).astype("<u4")


class IdWriter:
    """Writes documents to one file."""

    def __init__(self, uri: str):
        self.uri, self.stream = uri, open_output(uri)
        self.stream.write(MAGIC)
        self.at, self.n_ids = len(MAGIC), 0
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.starts: list[int] = []
        self.keys: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= 8 * BLOCK_IDS:
            self._flush(whole_blocks=True)

    def _flush(self, whole_blocks: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        end = len(ids) - len(ids) % BLOCK_IDS if whole_blocks else len(ids)
        for first in range(0, end, BLOCK_IDS):
            block = encode_block(ids[first : min(first + BLOCK_IDS, end)])
            self.starts.append(self.at)
            self.stream.write(block)
            self.at += len(block)
        self.waiting, self.n_waiting = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._flush(whole_blocks=False)
        keys = np.array([key or 0 for key in self.keys], "<i8")
        nulls = np.array([key is None for key in self.keys], "u1")
        for part in (np.array(self.starts, "<u8"), keys, nulls, np.array(self.lengths, "<u8")):
            self.stream.write(part.tobytes())
        counts = (len(self.starts), len(self.keys), self.n_ids, self.at)
        self.stream.write(_COUNTS.pack(*counts) + MAGIC)
        self.stream.close()


class IdReader:
    """Reads one file; blocks are fetched by the start index."""

    def __init__(self, uri: str):
        self.file = open_input(uri)
        size, tail = self.file.size(), _COUNTS.size + len(MAGIC)
        if size < tail + len(MAGIC):
            raise ValueError(f"not a token file: {uri}")
        end = self.file.read_at(tail, size - tail)
        if end[_COUNTS.size :] != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        n_blocks, n_docs, self.n_ids, footer = _COUNTS.unpack_from(end)
        data = self.file.read_at(size - tail - footer, footer)
        self.starts = np.append(np.frombuffer(data, "<u8", n_blocks), footer).astype(np.int64)
        self.keys = np.frombuffer(data, "<i8", n_docs, 8 * n_blocks)
        self.nulls = np.frombuffer(data, "u1", n_docs, 8 * (n_blocks + n_docs)).astype(bool)
        self.lengths = np.frombuffer(data, "<u8", n_docs, 8 * n_blocks + 9 * n_docs)
        self.ends = np.cumsum(self.lengths.astype(np.int64))

    def block(self, number: int) -> np.ndarray:
        start = int(self.starts[number])
        return decode_block(self.file.read_at(int(self.starts[number + 1]) - start, start))

    def ids(self, first: int, end: int) -> np.ndarray:
        """Ids ``first`` to ``end`` of the file."""
        if first >= end:
            return np.zeros(0, "<u4")
        low, high = first // BLOCK_IDS, (end - 1) // BLOCK_IDS
        found = np.concatenate([self.block(number) for number in range(low, high + 1)])
        return found[first - low * BLOCK_IDS : end - low * BLOCK_IDS]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Key, start in the file and ids of each document; each block is decoded once."""
        held, held_from, number = np.zeros(0, "<u4"), 0, 0
        for key, null, end, length in zip(self.keys, self.nulls, self.ends, self.lengths):
            first, end = int(end) - int(length), int(end)
            parts = [held[first - held_from :]]
            held_from, n_held = first, len(parts[0])
            while held_from + n_held < end:
                parts.append(self.block(number))
                n_held += len(parts[-1])
                number += 1
            held = np.concatenate(parts)
            yield None if null else int(key), first, held[: end - first]


class WordEncoder:
    """Ids of texts by a tokenizer file, whose words are encoded by themselves.

    Fit for tokenizers that lower-case, split at white space, drop it, and part
    letters from punctuation, with a mark on the last piece of each part. Then the
    ids of a text are those of its stretches without white space, one after the
    other, and those of letters and punctuation after them are the ids of both.
    """

    _by_path: dict[str, "WordEncoder"] = {}

    def __init__(self, path: str, word_end: str = "</w>"):
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[n for token, n in vocabulary.items() if token.endswith(word_end)]] = True

    @classmethod
    def of(cls, path: str) -> "WordEncoder":
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [
            np.array(found.ids, dtype="<u4").tobytes()
            for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words of letters, encoded as one text and cut at word ends."""
        found = []
        for first in range(0, len(words), 1000):
            part = words[first : first + 1000]
            ids = np.frombuffer(self._encode([" ".join(part)])[0], "<u4")
            ends = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
            if len(ends) != len(part):
                found += self._encode(part)
                continue
            data = ids.tobytes()
            found += [data[4 * a : 4 * b] for a, b in zip([0, *ends[:-1]], ends)]
        return found

    def _learn(self, words: list[str]) -> None:
        known, others, plain = self.known, [], []
        for word in words:
            match = _LETTERS.fullmatch(word)
            if match is None:
                others.append(word)
            else:
                plain.append((word, match[1].lower(), match[2]))
        cores = list({core for _, core, _ in plain if core not in known})
        known.update(zip(cores, self._encode_letters(cores)))
        stops = list({stop for _, _, stop in plain if stop and stop not in known})
        known.update(zip(stops, self._encode(stops)))
        for word, core, stop in plain:
            known[word] = known[core] + known[stop] if stop else known[core]
        known.update(zip(others, self._encode(others)))

    def ids(self, text: str) -> np.ndarray:
        if any(control in text for control in _NOT_SPACE):
            return np.frombuffer(self._encode([text])[0], "<u4")
        words = text.split()
        known = self.known
        missing = [word for word in set(words) if word not in known]
        if missing:
            if len(known) + 2 * len(missing) > REMEMBERED_WORDS:
                known.clear()
                missing = list(set(words))
            self._learn(missing)
        return np.frombuffer(b"".join([known[word] for word in words]), "<u4")


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
) -> DataFrame:
    """Encode the texts and write their ids in ascending order of ``id_col``.

    Each document ends with ``end_id``. A null or empty text has that id alone;
    rows with a null id come first; repeated ids keep all their rows, in the order
    of a hash of the text. Returns the manifest: ``file_no``, ``file``, ``n_docs``,
    ``n_ids`` and ``start``, the number of ids in all files before it. Only files
    in the manifest count.
    """
    spark = docs.sparkSession
    root = path or work_path(spark)
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(n_parts, "key")
        .sortWithinPartitions("key", "tie")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, files = WordEncoder.of(tokenizer_path), None, []
        end = np.array([end_id], "<u4")
        part = TaskContext.get().partitionId()

        def finish() -> None:
            writer.close()
            number = (part << 20) + len(files)
            files.append((number, writer.uri, len(writer.keys), writer.n_ids))

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                if writer is None:
                    writer = IdWriter(f"{root}/{attempt_name(len(files), '.pfor')}")
                writer.add(key, np.concatenate((encoder.ids(text.as_py() or ""), end)))
                if writer.n_ids >= FILE_IDS:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        if files:
            names = ["file_no", "file", "n_docs", "n_ids"]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*files)], names=names)

    listed = work_table(
        ordered.mapInArrow(write, "file_no long, file string, n_docs long, n_ids long")
    )
    # One row per file of up to FILE_IDS ids: small enough for the driver.
    rows, start = [], 0
    for row in sorted(listed.collect()):
        rows.append((*row, start))
        start += row["n_ids"]
    return spark.createDataFrame(
        rows, "file_no long, file string, n_docs long, n_ids long, start long"
    )


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``ids`` (little-endian unsigned 32-bit) of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            types = (pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(x, kind) for x, kind in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "ids"])

        for files in batches:
            for file, start in zip(files["file"].to_pylist(), files["start"].to_pylist()):
                rows, size = [], 0
                for key, first, ids in IdReader(file).documents():
                    rows.append((key, start + first, ids.tobytes()))
                    size += 4 * len(ids)
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    n_files = max(1, manifest.count())
    spread = manifest.select("file_no", "file", "start").repartitionByRange(n_files, "file_no")
    return spread.mapInArrow(read, "doc_id long, start long, ids binary")
