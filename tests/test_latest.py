"""Latest versions of objects that share a key, against SQL."""

from collections import Counter

import duckdb
from pyspark.sql import functions as F

from shoal.operators import listing
from shoal.plans import registry


def test_users_that_share_a_key_have_latest_versions_each(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    # users of five digits: 10000 to 10009 have the key of 1000
    later = events.select((F.col("event_id") + 1_000_000).alias("event_id"), "ts", (F.col("user_id") + 10_000).alias("user_id"), *events.columns[3:])
    events.unionByName(later).write.parquet(f"{tmp_path}/events.parquet")
    got = registry.queries()["latest_version"](spark, str(tmp_path)).collect()
    duck = duckdb.connect()
    duck.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    found = duck.execute(f"select key, version_id, last_modified::timestamp, size from ({registry.oracle_sql()['latest_version']})").fetchall()
    assert Counter(tuple(r) for r in got) == Counter(found)
    assert len({r.key for r in got}) < len(got)


def test_latest_is_of_keys_by_default(spark):
    rows = spark.createDataFrame([("a", "1", 1, 5, False, 1), ("a", "2", 2, 6, False, 2), ("b", "3", 1, 7, False, 1), ("b", "4", 2, None, True, 2)], "key string, version_id string, last_modified int, size int, is_delete_marker boolean, owner int")
    assert [tuple(r) for r in listing.latest(rows).collect()] == [("a", "2", 2, 6)]
    assert sorted(tuple(r) for r in listing.latest(rows, of=["owner", "key"]).collect()) == [("a", "1", 1, 5), ("a", "2", 2, 6), ("b", "3", 1, 7)]
