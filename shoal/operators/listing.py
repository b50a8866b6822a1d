"""Object listings as relations: prefixes, roll-up by delimiter, pages, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.operators.running import running

#: Keys of a page, at most.
MAX_KEYS = 1000


def under(objects: DataFrame, prefix: str = "", *, after: str | None = None, key: str = "key") -> DataFrame:
    """Objects whose key has a prefix and is beyond another key. Both reach the scan as range filters."""
    out = objects.where(F.col(key).startswith(prefix)) if prefix else objects
    return out.where(F.col(key) > after) if after is not None else out


def delimiter_of(delimiter: str | None, recursive: bool) -> str | None:
    """An explicit delimiter counts; else none for a recursive listing, and a slash for another."""
    return delimiter if delimiter is not None else None if recursive else "/"


def entry(prefix: str, delimiter: str, key: str = "key") -> Column:
    """The common prefix of a key below ``prefix``, or null if it has none."""
    rest = F.substring(F.col(key), F.lit(len(prefix) + 1), F.length(key))
    return F.when(F.instr(rest, delimiter) > 0, F.concat(F.lit(prefix), F.substring_index(rest, delimiter, 1), F.lit(delimiter)))


def common_prefixes(objects: DataFrame, prefix: str = "", delimiter: str = "/", *, after: str | None = None) -> DataFrame:
    """(key, n_objects, bytes): what lies below each common prefix. Partial sums leave little to shuffle."""
    rows = under(objects, prefix, after=after).withColumn("common", entry(prefix, delimiter)).where("common is not null")
    return rows.groupBy(F.col("common").alias("key")).agg(F.count("*").alias("n_objects"), F.sum("size").alias("bytes"))


def listing(objects: DataFrame, prefix: str = "", *, delimiter: str | None = None, recursive: bool = False, after: str | None = None) -> DataFrame:
    """(key, size, is_prefix): objects, and common prefixes as rows of their own, in no order."""
    mark, rows = delimiter_of(delimiter, recursive), under(objects, prefix, after=after)
    if mark is None:
        return rows.select("key", "size", F.lit(False).alias("is_prefix"))
    rolled = rows.withColumn("common", entry(prefix, mark))
    content = rolled.where("common is null").select("key", "size", F.lit(False).alias("is_prefix"))
    folders = rolled.where("common is not null").select(F.col("common").alias("key")).distinct().select("key", F.lit(None).cast("bigint").alias("size"), F.lit(True).alias("is_prefix"))
    return content.unionByName(folders)


def page(entries: DataFrame, *, after: str | None = None, limit: int = MAX_KEYS) -> DataFrame:
    """The first entries by key beyond a marker: keyset paging, as a top-k and not a sort of all."""
    if not 1 <= limit <= MAX_KEYS:
        raise ValueError(f"a page has 1 to {MAX_KEYS} keys")
    return (entries.where(F.col("key") > after) if after is not None else entries).orderBy("key").limit(limit)


def _with_state(rows: DataFrame, order: list[Column], limit: int, **markers: Column) -> DataFrame:
    """The first rows of a page that has one more; each says whether there is one more, and then where the next page starts. The rows are a page's, so one task sees them."""
    every = Window.partitionBy(F.lit(0))
    placed = rows.withColumn("place", F.row_number().over(every.orderBy(*order))).withColumn("is_truncated", F.max("place").over(every) > limit)
    last = {name: F.when(F.col("is_truncated"), F.max(F.when(F.col("place") == limit, c)).over(every)) for name, c in markers.items()}
    return placed.withColumns(last).where(F.col("place") <= limit).drop("place")


def page_with_state(entries: DataFrame, *, after: str | None = None, limit: int = MAX_KEYS) -> DataFrame:
    """A page, with ``is_truncated`` and ``next_marker`` (null on the last page) in each row. The marker is the last entry's key; prefixes count as entries."""
    if not 1 <= limit <= MAX_KEYS:
        raise ValueError(f"a page has 1 to {MAX_KEYS} keys")
    rows = (entries.where(F.col("key") > after) if after is not None else entries).orderBy("key").limit(limit + 1)
    return _with_state(rows, [F.col("key")], limit, next_marker=F.col("key"))


def versions_page(versions: DataFrame, *, key_marker: str | None = None, version_marker: str | None = None, limit: int = MAX_KEYS) -> DataFrame:
    """A page of versions and delete markers by key, the newest first, with ``is_truncated``, ``next_key_marker`` and ``next_version_marker`` in each row.

    It begins beyond a version of a key, or with only a key beyond all of its versions.
    """
    if version_marker is not None and key_marker is None:
        raise ValueError("a version marker needs a key marker")
    rows, number = versions, F.col("version_id").cast("bigint")
    if key_marker is not None:
        beyond = F.col("key") > key_marker
        at = versions.where((F.col("key") == key_marker) & (F.col("version_id") == version_marker)).select("last_modified", number.alias("n")).first() if version_marker is not None else None
        if at:
            beyond = beyond | (F.col("key") == key_marker) & ((F.col("last_modified") < F.lit(at["last_modified"]).cast("timestamp_ntz")) | (F.col("last_modified") == F.lit(at["last_modified"]).cast("timestamp_ntz")) & (number < at["n"]))
        rows = versions.where(beyond)
    order = [F.col("key"), F.desc("last_modified"), number.desc()]
    return _with_state(rows.orderBy(*order).limit(limit + 1), order, limit, next_key_marker=F.col("key"), next_version_marker=F.col("version_id"))


def pages(entries: DataFrame, limit: int = MAX_KEYS):
    """All pages one after another, until one isn't truncated. A marker that doesn't move on ends them, too."""
    after = None
    while True:
        rows = page_with_state(entries, after=after, limit=limit).orderBy("key").collect()
        if rows:
            yield rows
        if not rows or not rows[0]["is_truncated"] or rows[0]["next_marker"] == after:
            return
        after = rows[0]["next_marker"]


def latest(versions: DataFrame, *, of: list[str] | None = None) -> DataFrame:
    """The newest version of each object, without objects whose newest is a delete marker. One aggregation, no window.

    ``of``: the columns that tell objects apart, the key by default. Those that share a key, as where keys are padded to a width and longer ones are cut to it, have a row each.
    """
    newest = F.max_by(F.struct("key", "version_id", "last_modified", "size", "is_delete_marker"), F.struct("last_modified", F.col("version_id").cast("bigint")))
    return versions.groupBy(*(of or ["key"])).agg(newest.alias("x")).where("not x.is_delete_marker").select("x.key", "x.version_id", "x.last_modified", "x.size")


def versions_in_order(content: DataFrame, markers: DataFrame) -> DataFrame:
    """Versions and delete markers as one relation with the columns of both, ``place`` is the order within a key, newest first."""
    return running(content.unionByName(markers, allowMissingColumns=True), ["key"], [F.desc("last_modified"), F.desc(F.col("version_id").cast("bigint"))])


def list_objects(objects: DataFrame, versions: DataFrame, prefix: str = "", *, use_v1: bool = False, include_versions: bool = False, delimiter: str | None = None, recursive: bool = False, marker: str | None = None, start_after: str | None = None, key_marker: str | None = None) -> DataFrame:
    """(key, version_id, is_delete_marker, size, is_prefix): a listing of one of three kinds. The first counts before versions, and versions before the second.

    Each kind has its own start: ``marker``, ``start_after``, or ``key_marker`` (where that is null, ``start_after``).
    """
    mark = delimiter_of(delimiter, recursive)
    none = [F.lit(None).cast("string").alias("version_id"), F.lit(False).alias("is_delete_marker")]
    if use_v1 or not include_versions:
        return listing(objects, prefix, delimiter=delimiter, recursive=recursive, after=marker if use_v1 else start_after).select("key", *none, "size", "is_prefix")
    rows = under(versions, prefix, after=key_marker if key_marker is not None else start_after)
    own = lambda x: x.select("key", "version_id", "is_delete_marker", "size", F.lit(False).alias("is_prefix"))
    if mark is None:
        return own(rows)
    rolled = rows.withColumn("common", entry(prefix, mark))
    folders = rolled.where("common is not null").select(F.col("common").alias("key")).distinct().select("key", *none, F.lit(None).cast("bigint").alias("size"), F.lit(True).alias("is_prefix"))
    return own(rolled.where("common is null")).unionByName(folders)


def buckets(objects: DataFrame) -> DataFrame:
    """Namespaces with their first object's time: the first part of a key is the bucket."""
    return objects.groupBy(F.substring_index("key", "/", 1).alias("name")).agg(F.min("last_modified").alias("creation_date"), F.count("*").alias("n_objects"))
