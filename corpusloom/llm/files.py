"""Binary files that tasks write to and read from shared storage."""

import uuid

from pyarrow import fs
from pyspark import TaskContext


def open_output(uri: str):
    """A stream to a new file; parent folders are made."""
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A seekable file."""
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def attempt_name(sequence: int, suffix: str) -> str:
    """A file name no other attempt of any task uses.

    A retried or speculative attempt leaves files of its own; only those count
    whose names reached the manifest through Spark's commit.
    """
    return f"part-{TaskContext.get().partitionId():06d}-{sequence:04d}-{uuid.uuid4().hex}{suffix}"
