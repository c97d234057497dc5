import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))

from corpusloom.session import SESSION_CONF, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # The frames are tiny: compiling a stage would cost more than running it.
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a Column function to rows of arguments; returns the list of values."""

    def apply(function, rows):
        rows = [(n, *(row if isinstance(row, tuple) else (row,))) for n, row in enumerate(rows)]
        width = len(rows[0]) - 1
        names = [f"a{n}" for n in range(width)]
        schema = ", ".join(["n int", *[f"{name} string" for name in names]])
        frame = spark.createDataFrame(rows, schema)
        out = frame.select("n", function(*names).alias("value")).collect()
        return [row["value"] for row in sorted(out, key=lambda r: r["n"])]

    return apply
