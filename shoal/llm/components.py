"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.storage import dropped, stored


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 50) -> DataFrame:
    """(node, label) of every node with a link; the label is the least node that links reach.

    Alternates large-star and small-star steps, each of which hangs neighbours on the least node they know, until no link changes.
    Every step is an aggregation and a join on nodes and its links are stored, so that lineage stays short.
    """
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct()
    before = None
    for _ in range(rounds):
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # small star: every node's smaller neighbours, and itself, hang on the least of them
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        last, links = links, stored(small)
        if before is not None:
            dropped(last)  # of the round before
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"links still change after {rounds} rounds")
    labels = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.union(labels.select(F.col("label").alias("node"), "label").distinct())
