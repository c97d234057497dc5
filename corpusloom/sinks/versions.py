"""Numbered version folders: ``base-N`` and the ``delta-N`` written after it.

A delta may carry the key of the batch it came from, as ``delta-N.KEY``. A batch that is
written again gets a new number and replaces its earlier delta for readers.
"""

import re
from dataclasses import dataclass

from pyspark.sql import SparkSession

_NAME = re.compile(r"(base|delta)-(\d+)(?:\.(.+))?")


@dataclass(frozen=True)
class Version:
    kind: str
    number: int
    path: str
    batch: str | None = None


def hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = hadoop_path(spark, path)
    return fs.exists(jvm_path)


def versions(
    spark: SparkSession, root: str, finished: bool = True, marker: str = "_SUCCESS"
) -> list[Version]:
    fs, jvm_path = hadoop_path(spark, root)
    if not fs.exists(jvm_path):
        return []
    found = []
    for status in fs.listStatus(jvm_path):
        name = status.getPath().getName()
        if match := _NAME.fullmatch(name):
            path = f"{root}/{name}"
            if not finished or path_exists(spark, f"{path}/{marker}"):
                found.append(Version(match[1], int(match[2]), path, match[3]))
    return sorted(found, key=lambda v: v.number)


def live_versions(
    spark: SparkSession, root: str, marker: str = "_SUCCESS"
) -> tuple[Version | None, list[Version]]:
    """The newest finished base and the finished deltas after it, one per batch."""
    found = versions(spark, root, marker=marker)
    base = max((v for v in found if v.kind == "base"), key=lambda v: v.number, default=None)
    after = base.number if base else -1
    deltas = [v for v in found if v.kind == "delta" and v.number > after]
    newest = {v.batch: v.number for v in deltas}
    return base, [v for v in deltas if v.batch is None or newest[v.batch] == v.number]


def next_version(spark: SparkSession, root: str, kind: str, batch: str | None = None) -> str:
    number = max((v.number for v in versions(spark, root, finished=False)), default=-1) + 1
    key = "" if batch is None else "." + re.sub(r"[^\w\-]", "_", batch)
    return f"{root}/{kind}-{number:010d}{key}"
