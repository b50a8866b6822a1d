"""Deletes as a stream: keys in, an outcome for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from shoal.operators import transfer


def delete_stream(keys: DataFrame, objects: Callable[[], DataFrame], path: str, checkpoint: str, *, most: int = transfer.DELETE_BATCH) -> DataStreamWriter:
    """Writes (key, outcome, batch) of each micro-batch below ``path``. ``objects`` gives the objects as they are then.

    Keys that aren't there are outcomes, and don't end the stream. A micro-batch that runs again replaces its own rows.
    """

    def apply(rows: DataFrame, number: int) -> None:
        dealt = transfer.delete_batches(rows.select("key").distinct(), most=most)
        outcome = transfer.delete_outcome(dealt, objects()).join(dealt, "key")
        outcome.write.mode("overwrite").parquet(f"{path}/micro_batch={number}")

    return keys.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
