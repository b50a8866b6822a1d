"""Folders for tables that a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``. Where that is unset, as in tests on one machine, in a local folder; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.gettempdir()}/shoal-shared"
    return f"{root.rstrip('/')}/table-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Writes a table and reads it again, so that all its readers see one evaluation."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
