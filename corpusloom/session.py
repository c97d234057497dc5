"""Session defaults the package is written for."""

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "corpusloom", **conf: str) -> SparkSession:
    """A session with the package's defaults; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needed where the executors do not have it installed.
    """
    context = spark.sparkContext
    if getattr(context, "_corpusloom_shipped", False):
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="corpusloom-")) / "corpusloom.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._corpusloom_shipped = True
