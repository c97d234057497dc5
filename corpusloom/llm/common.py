"""Helpers shared by the operators of this subpackage."""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..plans import shared_dir

#: Bytes of text that one step of array work covers; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

#: Word separators: space and the controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[ord("A") : ord("Z") + 1] += 32

# One random 64-bit value per byte, and the odd base of the rolling hashes.
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def work_table(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage and survives lost executors. The folder is removed when the
    application ends.
    """
    spark = df.sparkSession
    path = work_path(spark)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete the files of work tables that nothing reads any more."""
    for table in tables:
        for path in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            folder = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            conf = table.sparkSession._jsc.hadoopConfiguration()
            folder.getFileSystem(conf).delete(folder, True)


def free_names(df: DataFrame, count: int) -> list[str]:
    """Column names that ``df`` does not have, in any case."""
    taken = {name.lower() for name in df.columns}
    return [name for n in range(len(taken) + count) if (name := f"own_{n}") not in taken][:count]


def work_path(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder, removed when the application ends."""
    context = spark.sparkContext
    root = f"{shared_dir(spark).rstrip('/')}/llm-{context.applicationId}"
    if getattr(context, "_llm_work_root", None) != root:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(folder)
        system.deleteOnExit(folder)
        context._llm_work_root = root
    return f"{root}/{uuid.uuid4().hex}"


def text_blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES):
    """Split a batch into runs of rows of about ``limit`` bytes of text.

    Yields ``(first_row, data, offsets)``: the UTF-8 bytes of the run and the
    ``rows + 1`` offsets of its texts. A null text is empty.
    """
    column_data = batch.column(column).cast(pa.large_binary())
    if column_data.null_count:
        column_data = column_data.fill_null(b"")
    if not len(column_data):
        return
    _, offsets, values = column_data.buffers()
    offsets = np.frombuffer(offsets, np.int64)[
        column_data.offset : column_data.offset + len(column_data) + 1
    ]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column_data):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column_data))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mix64(values: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on all others."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """Start and end of each word, and the index of each text's first word.

    Words are runs of bytes outside ``SEPARATOR``; none crosses a text's end.
    """
    edge = np.ones(len(data) + 1, dtype=bool)
    if len(data):
        inside = ~SEPARATOR[data]
        edge[1:-1] = False
        edge[offsets] = True
        before = np.concatenate(([False], inside[:-1]))
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.concatenate((inside[1:], [False]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    else:
        starts = ends = np.zeros(0, np.int64)
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the ascending, disjoint and non-empty spans."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    powers = np.full(int(lengths.max()), _BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    filled = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    at = np.arange(len(filled)) + filled
    place = at - np.repeat(starts, lengths)
    terms = _BYTE_VALUES[data[at]] * powers[place]
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return mix64(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` successive values (uint64)."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    # Runs of 1, 2, 4, ... are joined to the width asked for.
    power, size, base = values.astype(np.uint64), 1, _BASE
    total, covered = None, 0
    left = width
    while left:
        if left & 1:
            if total is None:
                total, covered = power.copy(), size
            else:
                n = len(values) - covered - size + 1
                total = total[:n] * base + power[covered : covered + n]
                covered += size
        left >>= 1
        if left:
            n = len(power) - size
            power = power[:n] * base + power[size:]
            base = np.uint64((int(base) * int(base)) & 0xFFFFFFFFFFFFFFFF)
            size *= 2
    return mix64(total[: len(values) - width + 1])


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def flat_ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...`` for ``counts[i]`` values, of all i in turn."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(first - (ends - counts), counts)
