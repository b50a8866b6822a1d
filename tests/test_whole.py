"""Queries that take all rows and whole texts, against plain versions; test_queries compares them with their SQL."""

from collections import defaultdict
from urllib.parse import quote

from shoal.plans import registry


def test_requests_have_all_events(spark, sf):
    want = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/events.parquet").collect():
        want[r.user_id, r.event_id // 1000].append((r.event_type, r.event_id, str(int(r.value + 0.5))))
    got = {(r.user_id, r.request): r["query"] for r in registry.queries()["canonical_query"](spark, sf).collect()}
    assert got == {k: "&".join(f"{name}={v}" for name, _, v in sorted(x)) for k, x in want.items()}


def test_all_notifications_land(spark, sf):
    got = [r.event_id for r in registry.queries()["notification_stream"](spark, sf).collect()]
    assert sorted(got) == sorted(r.event_id for r in spark.read.parquet(f"{sf}/events.parquet").collect())


def test_all_objects_are_deleted(spark, sf):
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = registry.queries()["delete_missing"](spark, sf).groupBy("outcome").count().collect()
    assert {r.outcome: r["count"] for r in rows} == {"deleted": n, "skipped": n}


def test_keys_are_encoded_to_their_end(spark, sf):
    want = {r.doc_id: quote(r.text, safe="/-._~") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.encoded for r in registry.queries()["encode_key"](spark, sf).collect()}
    assert got == want and max(map(len, got.values())) > 10_000
