"""Running numbers and sums that one hot key can't stop.

A window by key sorts all rows of a key in one task.  Here rows are dealt by ranges of key and order; numbers and sums run inside a range, and
what earlier ranges hold of the range's first key is added.  Only the first key of a range can begin before it, so that is a row for each range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.sources.storage import stored

_RANGE = "running range"


def running(df: DataFrame, by: list[str], order: list[Column], *, sums: tuple[str, ...] = (), previous: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``place`` (from 1), ``before <c>`` for each of ``sums`` and ``previous <c>`` for each of ``previous``, in an order within the key ``by``, which may be empty.

    Nulls count as 0 in sums; a first row has no previous value.  Rows of equal order have an arbitrary order of their own.
    The ranges are stored, as their bounds come from a sample and another evaluation may have others.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{c}`") for c in by]
    ranged = df.repartitionByRange(n, *keys, *order).withColumn(_RANGE, F.spark_partition_id())
    inside = Window.partitionBy(_RANGE, *keys).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    own = {"place": F.row_number().over(inside).cast("bigint")}
    own |= {f"before {c}": F.coalesce(F.sum(f"`{c}`").over(upto), none) for c in sums}
    own |= {f"previous {c}": F.lag(f"`{c}`").over(inside) for c in previous}
    rows = stored(ranged.withColumns(own))

    held = [F.count("*").alias("carry place"), *[F.coalesce(F.sum(f"`{c}`"), none).alias(f"carry before {c}") for c in sums]]
    held += [F.max_by(f"`{c}`", "place").alias(f"carry previous {c}") for c in previous]
    parts = rows.groupBy(_RANGE, *keys).agg(*held)
    earlier = Window.partitionBy(*keys).orderBy(_RANGE)  # as many rows as a key has ranges
    added = {f"carry {c}": F.sum(f"`carry {c}`").over(earlier.rowsBetween(Window.unboundedPreceding, -1)) for c in ["place", *[f"before {c}" for c in sums]]}
    added |= {f"carry previous {c}": F.lag(f"`carry previous {c}`").over(earlier) for c in previous}
    carry = parts.withColumns(added).where("`carry place` is not null")  # a row for each range at most
    carry = F.broadcast(carry.withColumnsRenamed({c: f"carry of {c}" for c in [_RANGE, *by]}))
    same = F.col(f"`{_RANGE}`") == F.col(f"`carry of {_RANGE}`")
    for c in by:
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`carry of {c}`"))
    total = {c: F.col(f"`{c}`") + F.coalesce(F.col(f"`carry {c}`"), none) for c in ["place", *[f"before {c}" for c in sums]]}
    last = {f"previous {c}": F.when(F.col("place") == 1, F.col(f"`carry previous {c}`")).otherwise(F.col(f"`previous {c}`")) for c in previous}
    return rows.join(carry, same, "left").select(*[F.col(f"`{c}`") for c in df.columns], *[x.alias(c) for c, x in (total | last).items()])


def rolling(events: DataFrame, by: list[str], time: str, span: int, **aggregates: Column) -> DataFrame:
    """Adds aggregates over the events of a key in the ``span`` microseconds up to each event, itself included.

    An event is also dealt to the span after its own: so a task sorts two spans of a key, and not all of it.
    """
    moment = F.unix_micros(F.col(time).cast("timestamp"))
    rows = events.withColumns({"rolling at": moment, "rolling own": F.floor(moment / F.lit(span)).cast("bigint")})
    dealt = rows.withColumn("rolling span", F.explode(F.array(F.col("rolling own"), F.col("rolling own") + 1)))
    window = Window.partitionBy(*by, "rolling span").orderBy("rolling at").rangeBetween(1 - span, 0)
    found = dealt.withColumns({name: x.over(window) for name, x in aggregates.items()})
    return found.where(F.col("rolling span") == F.col("rolling own")).drop("rolling at", "rolling own", "rolling span")
