"""Session settings of the library, and its code on the executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

#: Settings that the functions rely on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.chunkBase64String.enabled": "false",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.python.filterPushdown.enabled": "true",
    # batches of 10,000 rows of long texts or packed arrays take several times their size beside the heap
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}
_shipped: set[str] = set()


def prepared(spark: SparkSession) -> SparkSession:
    """Applies the settings and ships the package to the executors, once an application."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="shoal-code-")  # the driver serves the archive from here while the application runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        shutil.copytree(package, os.path.join(folder, "code", "shoal"), ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(os.path.join(folder, "shoal-code"), "zip", os.path.join(folder, "code")))
        _shipped.add(context.applicationId)
    return spark
