"""Whole objects as rows, and checksums of objects that come in chunks."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def contents(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, last_modified, content) of the files below a folder; columns that aren't used aren't read.

    Spark's reader gives no row for an empty file; the source ``object_listing`` lists those, too.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"), "content")


class _Crc32:
    def __init__(self):
        self.state = 0

    def update(self, data: bytes) -> None:
        self.state = zlib.crc32(data, self.state)

    def digest(self) -> bytes:
        return self.state.to_bytes(4, "big")


def _hasher(algorithm: str):
    name = algorithm.upper()
    if name == "CRC32":
        return _Crc32()
    if name in ("MD5", "SHA1", "SHA256", "SHA512"):
        return hashlib.new(name.lower())
    import xxhash

    return {"XXHASH64": xxhash.xxh64, "XXHASH3": xxhash.xxh3_64, "XXHASH128": xxhash.xxh3_128}[name]()


#: Algorithms that go on from where a chunk ends.
CHUNKED = ("CRC32", "MD5", "SHA1", "SHA256", "SHA512", "XXHASH64", "XXHASH3", "XXHASH128")


def chunk_checksums(chunks: DataFrame, algorithm: str, *, by: str, order: str, content: str) -> DataFrame:
    """(by, checksum) of objects whose content comes in chunks, in their order. A null chunk is empty.

    Chunks go by in order and only a hash's state is kept, so that an object may be larger than a task's memory.
    """
    if algorithm.upper() not in CHUNKED:
        raise ValueError(f"no checksum of chunks: {algorithm}")
    kind = chunks.schema[by].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1), strict=True):
                if state is None or name != key:
                    if state is not None:
                        done.append((key, state.digest()))
                    key, state = name, _hasher(algorithm)
                if data.is_valid:
                    state.update(data.as_buffer())
            yield packed(done, batch.schema.field(0).type)
            done = []
        if state is not None:
            yield packed([(key, state.digest())], key.type)

    def packed(rows: list[tuple[pa.Scalar, bytes]], of: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k.as_py() for k, _ in rows], of), pa.array([base64.b64encode(d).decode() for _, d in rows], pa.string())], names=[by, "checksum"])

    rows = chunks.select(F.col(by), F.col(content).cast("binary").alias("chunk"), F.col(order).alias("chunk order"))
    dealt = rows.repartition(F.col(by)).sortWithinPartitions(by, "chunk order").select(by, "chunk")
    return dealt.mapInArrow(digests, f"`{by}` {kind}, checksum string")
