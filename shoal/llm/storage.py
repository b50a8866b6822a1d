"""Where operators put tables that a later step reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a row group. Writers hold one in memory, and readers the columns of one, beside the workers of their tasks.
GROUP_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """A new path below ``spark.checkpoint.dir``. Where that is unset, as in tests on one machine, below a local folder; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.gettempdir()}/shoal-shared"
    return f"{root.rstrip('/')}/shoal-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder and reads it again: lineage ends there, and a lost executor costs no step before it."""
    path = shared_folder(df.sparkSession)
    df.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` has written and nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
