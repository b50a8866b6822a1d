"""Copies, renames and purges: requests against the objects that are there, by joins on keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.operators import conditions, transfer
from shoal.operators.running import running


def with_stat(requests: DataFrame, objects: DataFrame, key: str, name: str = "stat") -> DataFrame:
    """Adds the struct (size, etag, last_modified) of the object that a column names; null where there is none."""
    there = objects.select(F.col("key").alias(f"{name} key"), F.struct("size", "etag", "last_modified").alias(name))
    return requests.join(there, F.col(key) == F.col(f"`{name} key`"), "left").drop(f"{name} key")


def compose_sources(sources: DataFrame, objects: DataFrame, *, by: str, order: str, part: int = transfer.MAX_PART) -> DataFrame:
    """``transfer.compose`` of sources (key, offset, length, match) with the sizes of the objects they name. A source that isn't there, or isn't as ``match`` says, has that as its error."""
    found = with_stat(sources, objects, "key")
    failed = F.when(F.col("stat").isNull(), F.lit("not_found")).otherwise(conditions.failed(F.col("stat.etag"), F.col("stat.last_modified"), match=F.col("match")))
    ready = found.select(by, order, F.col("stat.size").alias("size"), F.col("offset").cast("bigint").alias("offset"), F.col("length").cast("bigint").alias("length"), failed.alias("failed"))
    planned = transfer.compose(ready, by=by, order=order, part=part)
    return planned.join(ready.select(by, order, "failed"), [by, order]).withColumn("error", F.coalesce("failed", "error")).drop("failed")


def copies(requests: DataFrame, objects: DataFrame, *, part: int = transfer.MAX_PART) -> DataFrame:
    """Plans copies (source, target, offset, length, directive; the last three may be null): adds ``bytes``, ``parts``, ``how`` and ``error``.

    A range, or more than a part, is composed of parts at the target; the directive COPY isn't possible then.
    """
    size = F.col("stat.size")
    start = F.coalesce(F.col("offset"), F.lit(0))
    take = F.coalesce(F.col("length"), size - start)
    composed = F.col("offset").isNotNull() | F.col("length").isNotNull() | (size > part)
    error = F.coalesce(
        F.when(F.col("stat").isNull(), F.lit("not_found")),
        F.when(composed & (F.upper("directive") == "COPY"), F.lit("directive")),
        F.when(composed & (start >= size), F.lit("offset")),
        F.when(start + take > size, F.lit("range")),
    )
    found = with_stat(requests, objects, "source")
    good = lambda x: F.when(error.isNull(), x)
    return found.select(*[F.col(f"`{c}`") for c in requests.columns], good(take).cast("bigint").alias("bytes"), good(F.greatest(F.ceil(take / part), F.lit(1))).cast("bigint").alias("parts"), good(F.when(composed, "compose").otherwise("copy")).alias("how"), error.alias("error"))


def renames(requests: DataFrame, objects: DataFrame) -> DataFrame:
    """Adds ``error`` to renames (source, target, source_match, target_match, target_none_match; null: no condition): the first condition that fails, of the source and then of the target."""
    found = with_stat(with_stat(requests, objects, "source"), objects, "target", "stat of target")
    there = F.col("`stat of target`")
    of_source = conditions.failed(F.col("stat.etag"), F.col("stat.last_modified"), match=F.col("source_match"))
    of_target = conditions.failed(there["etag"], there["last_modified"], match=F.col("target_match"), none_match=F.col("target_none_match"))
    error = F.when(F.col("stat").isNull(), F.lit("not_found")).otherwise(F.coalesce(F.concat(F.lit("source_"), of_source), F.concat(F.lit("target_"), of_target)))
    return found.select(*[F.col(f"`{c}`") for c in requests.columns], error.alias("error"))


def purge(versions: DataFrame, *, hold: str | None = None, most: int = transfer.DELETE_BATCH) -> DataFrame:
    """(key, version_id, batch, release): every version and delete marker of a bucket in requests of ``most`` at most. ``release``: its hold is taken off, and it is deleted by itself, after its request."""
    order = [F.col("key"), F.col("version_id").cast("bigint")]
    release = F.coalesce(F.col(hold), F.lit(False)) if hold else F.lit(False)
    numbered = running(versions.select("key", "version_id", release.alias("release")), [], order)
    return numbered.select("key", "version_id", F.floor((F.col("place") - 1) / most).cast("bigint").alias("batch"), "release")
