"""Planning of transfers: parts of uploads, ranges, composition, appends, deletes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.operators.running import running

KIB, MIB, GIB = 1 << 10, 1 << 20, 1 << 30
MIN_PART, MAX_PART, DEFAULT_PART, MAX_PARTS = 5 * MIB, 5 * GIB, 64 * MIB, 10_000
MAX_OBJECT = MAX_PART * MAX_PARTS
#: Keys of a request to delete, and parts of a page of attributes.
DELETE_BATCH = MAX_KEYS = 1000


def part_error(size: Column, part: Column) -> Column:
    """Why an upload can't be planned; null if it can. Sizes of null are unknown."""
    return F.coalesce(
        F.when(part < MIN_PART, F.lit("part_too_small")),
        F.when(part > MAX_PART, F.lit("part_too_large")),
        F.when(size > MAX_OBJECT, F.lit("object_too_large")),
        F.when(size.isNull() & part.isNull(), F.lit("part_size_missing")),
        F.when((size == 0) & part.isNotNull(), F.lit("part_count_zero")),
        F.when(F.ceil(size / part) > MAX_PARTS, F.lit("too_many_parts")),
    )


def planned_part(size: Column, part: Column) -> Column:
    """The part size that is used: as asked for, or the default, grown in steps of the smallest part if there would be too many, and never more than the object."""
    grown = F.ceil(F.ceil(size / MAX_PARTS) / MIN_PART) * MIN_PART
    free = F.when(size <= DEFAULT_PART * MAX_PARTS, F.lit(DEFAULT_PART)).otherwise(grown)
    return F.coalesce(part, F.least(free, size)).cast("bigint")


def planned_parts(size: Column, part: Column) -> Column:
    """The number of parts; null if the size isn't known. An object without bytes is one part."""
    used = planned_part(size, part)
    return F.when(size == 0, F.lit(1)).when(size.isNotNull(), F.ceil(size / used)).cast("bigint")


def ranges(size: Column, part: Column) -> Column:
    """Array of (part_number, offset, length) that covers an object."""
    n = F.ceil(size / part).cast("bigint")
    return F.when(size > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.struct((i + 1).alias("part_number"), (i * part).alias("offset"), F.least(part, size - i * part).alias("length"))))


def compose(sources: DataFrame, *, by: str, order: str, part: int = MAX_PART) -> DataFrame:
    """Plans a target of several sources (size, offset, length; the last two may be null): a row for each source, with its first part number, parts, bytes and ``error``.

    All parts of a target but the last have the smallest size at least: so a source before the last must, and what is left of it after whole parts.

    Running sums go over a target's sources only.
    """
    start, available = F.coalesce(F.col("offset"), F.lit(0)), F.col("size")
    length = F.coalesce(F.col("length"), available - start)
    every, before = Window.partitionBy(by), Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = sources.withColumns({"take": length, "parts": F.ceil(length / part).cast("bigint"), "last": F.col(order) == F.max(order).over(every)})
    error = F.coalesce(
        F.when(start >= available, F.lit("offset")),
        F.when(F.col("take") > available, F.lit("length")),
        F.when(start + F.col("take") > available, F.lit("range")),
        F.when(~F.col("last") & (F.col("take") < MIN_PART), F.lit("source_too_small")),
        F.when(~F.col("last") & (F.col("take") > part) & (F.col("take") % part).between(1, MIN_PART - 1), F.lit("last_part_too_small")),
        F.when(F.sum("take").over(every) > MAX_OBJECT, F.lit("object_too_large")),
        F.when(F.sum("parts").over(every) > MAX_PARTS, F.lit("too_many_parts")),
    )
    return rows.select(by, order, F.col("take").alias("bytes"), "parts", (F.coalesce(F.sum("parts").over(before), F.lit(0)) + 1).alias("first_part"), F.sum("take").over(every).alias("target_bytes"), error.alias("error"))


def append_offsets(parts: DataFrame, *, by: str, order: str, length: str, start: str | None = None) -> DataFrame:
    """Where each part goes when parts are appended in order, and the size after it. A target of any number of parts is dealt to many tasks."""
    base = F.coalesce(F.col(start), F.lit(0)) if start else F.lit(0)
    before = F.col(f"`before {length}`")
    rows = running(parts, [by], [F.col(order)], sums=(length,))
    return rows.withColumns({"offset": base + before, "size_after": base + before + F.col(length)}).drop("place", f"before {length}")


def renamed(objects: DataFrame, source: str, target: str, *, key: str = "key") -> DataFrame:
    """(source, target) of the objects below a prefix, when that becomes another."""
    return objects.where(F.col(key).startswith(source)).select(F.col(key).alias("source"), F.concat(F.lit(target), F.substring(F.col(key), F.lit(len(source) + 1), F.length(key))).alias("target"))


def delete_batches(keys: DataFrame, *, key: str = "key", most: int = DELETE_BATCH) -> DataFrame:
    """Deals keys, in their order, to requests of ``most`` at most; a batch number is the same wherever partitions end."""
    return running(keys, [], [F.col(key)]).withColumn("batch", F.floor((F.col("place") - 1) / most).cast("bigint")).drop("place")


def delete_outcome(requests: DataFrame, objects: DataFrame, *, key: str = "key") -> DataFrame:
    """(key, outcome): keys that exist are deleted, missing ones are skipped."""
    there = objects.select(key).distinct().withColumn("there", F.lit(True))
    return requests.join(there, key, "left").select(key, F.when(F.col("there"), "deleted").otherwise("skipped").alias("outcome"))


def rechunked(df: DataFrame, content: str, size: int) -> DataFrame:
    """Splits binary or string content to blocks of exactly ``size``, but for the last."""
    n = F.ceil(F.octet_length(content) / size).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col(content).cast("binary"), i * size + 1, F.lit(size)))
    return df.select("*", F.posexplode(F.when(n > 0, blocks)).alias("block", "data"))


def range_read(content: Column, offset: int | None, length: int | None) -> Column:
    """Bytes of a range; a length alone starts at 0. A length of 0 isn't a range; see ``fast_read``."""
    if length == 0:
        raise ValueError("a range has at least one byte")
    start = (offset or 0) + 1
    return F.substring(content.cast("binary"), F.lit(start), F.lit(length) if length is not None else F.octet_length(content))


def fast_read(content: Column, offset: int, length: int) -> Column:
    """Bytes from an offset on; a length of 0 has no end."""
    return range_read(content, offset, length or None)


def attribute_page(parts: DataFrame, *, by: str, part: str = "part_number", after: int = 0, most: int = MAX_KEYS) -> DataFrame:
    """Adds ``is_truncated`` and ``next_marker`` to the first ``most`` parts of each object beyond a part number."""
    place, every = Window.partitionBy(by).orderBy(part), Window.partitionBy(by)
    rows = parts.where(F.col(part) > after).withColumn("place", F.row_number().over(place)).where(F.col("place") <= most + 1)
    rows = rows.withColumns({"is_truncated": F.max("place").over(every) > most, "next_marker": F.max(F.when(F.col("place") == most, F.col(part))).over(every)})
    return rows.where(F.col("place") <= most).withColumn("next_marker", F.when(F.col("is_truncated"), F.col("next_marker"))).drop("place")
