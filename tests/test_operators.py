"""Operators: golden cases, invariants, plans and streams."""

import os

import pytest
from pyspark.sql import functions as F

from shoal.functions.text import object_url
from shoal.operators import listing, rules, transfer
from shoal.operators.policy import PostPolicy
from shoal.sources import listing_source
from shoal.sources.relations import relation
from shoal.sources.select import CsvInput, CsvOutput, JsonInput, JsonOutput, ParquetInput, SelectRequest, scan_range, with_progress
from shoal.streaming import notifications

LINES = ["Year,Make,Model,Description,Price", '1997,Ford,E350,"ac, abs, moon",3000.00', '1999,Chevy,"Venture ""Extended Edition""","",4900.00', '1996,Jeep,Grand Cherokee,"MUST SELL!\nair, moon roof",4799.00']


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "cars.csv"
    path.write_text("\n".join(LINES) + "\n")
    return str(path)


def test_csv_round_trip(spark, csv):
    got = SelectRequest("select * from S3Object", CsvInput(), CsvOutput()).records(spark, csv)
    text = sorted(r.record for r in got.collect())
    assert text == sorted(x.replace('""",""', '""",') if "Venture" in x else x for x in LINES[1:])
    all_quoted = SelectRequest("select Year from S3Object", CsvInput(), CsvOutput(quote_all=True)).records(spark, csv)
    assert sorted(r.record for r in all_quoted.collect()) == ['"1996"', '"1997"', '"1999"']


def test_csv_headers_and_json(spark, csv):
    assert SelectRequest("select _2 from s3object", CsvInput(header="IGNORE")).rows(spark, csv).count() == 3
    assert SelectRequest("select _2 from S3Object", CsvInput(header="NONE")).rows(spark, csv).count() == 4
    records, seen = with_progress(SelectRequest("select Make, Price from S3Object where Year = '1997'", CsvInput(), JsonOutput()).records(spark, csv))
    assert [r.record for r in records.collect()] == ['{"Make":"Ford","Price":"3000.00"}']
    assert seen.get == {"records_returned": 1, "bytes_returned": 34}


@pytest.mark.parametrize("request_", [("", ParquetInput(), JsonOutput()), ("drop table x", ParquetInput(), JsonOutput()), ("select * from other", ParquetInput(), JsonOutput()), ("select 1", JsonInput(), CsvOutput())])
def test_bad_requests(request_):
    with pytest.raises(ValueError):
        SelectRequest(*request_)


def test_select_pushes_filters_down(spark, sf):
    plan = SelectRequest("select l_orderkey from S3Object where l_quantity > 45", ParquetInput()).rows(spark, f"{sf}/lineitem.parquet")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,45.0)" in plan and "l_comment" not in plan and "l_tax" not in plan


def test_compressed_input(spark, tmp_path):
    import gzip

    (tmp_path / "x.csv.gz").write_bytes(gzip.compress("\n".join(LINES).encode()))
    assert SelectRequest("select * from S3Object", CsvInput(compression="GZIP")).rows(spark, str(tmp_path)).count() == 3


def test_scan_ranges_join_up(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n\nthree\nfour")
    whole = sorted((r.offset, r.record) for r in scan_range(spark, str(tmp_path), 0, 100).collect())
    assert whole == [(0, "one"), (4, "two"), (8, ""), (9, "three"), (15, "four")]
    for cut in range(1, 18):
        parts = scan_range(spark, str(tmp_path), 0, cut - 1).union(scan_range(spark, str(tmp_path), cut, 100))
        assert sorted((r.offset, r.record) for r in parts.collect()) == whole


def test_pages_join_up(spark):
    keys = spark.createDataFrame([(f"max-keys-test-{i:03d}",) for i in range(15)], "key string")
    got = list(listing.pages(keys, 5))
    assert [len(p) for p in got] == [5, 5, 5] and [r.key for p in got for r in p] == sorted(r.key for r in keys.collect())
    with pytest.raises(ValueError):
        listing.page(keys, limit=1001)


def test_listing_invariants(spark, sf):
    objects = relation(spark, sf, "objects")
    rolled = listing.common_prefixes(objects, "", "/")
    assert rolled.agg(F.sum("n_objects")).first()[0] == objects.count()
    plan = listing.listing(objects, "src1", recursive=True)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    assert listing.delimiter_of(None, False) == "/" and listing.delimiter_of(None, True) is None and listing.delimiter_of("-", True) == "-"


def test_part_plans_cover_objects(spark):
    sizes = [1, 5 * transfer.MIB, 5 * transfer.MIB + 1, 123_456_789, transfer.MAX_PART * 3 + 7]
    df = spark.createDataFrame([(s, p) for s in sizes for p in (5 * transfer.MIB, 64 * transfer.MIB)], "s long, p long")
    for r in df.select("s", "p", transfer.ranges(F.col("s"), F.col("p")).alias("r"), transfer.planned_parts(F.col("s"), F.col("p")).alias("n")).collect():
        assert [x.part_number for x in r.r] == list(range(1, r.n + 1)) and sum(x.length for x in r.r) == r.s
        assert all(a.offset + a.length == b.offset for a, b in zip(r.r, r.r[1:], strict=False))
    null = F.lit(None).cast("bigint")
    error = lambda s, p: spark.range(1).select(transfer.part_error(s, p)).first()[0]
    assert error(F.lit(1), F.lit(1)) == "part_too_small" and error(null, null) == "part_size_missing" and error(F.lit(0), F.lit(64 * transfer.MIB)) == "part_count_zero"
    assert error(F.lit(10), null) is None and error(F.lit(200_000 * transfer.MIB), F.lit(5 * transfer.MIB)) == "too_many_parts"
    huge = F.lit(64 * transfer.MIB * 10_000 + 1)
    assert spark.range(1).select(transfer.planned_part(huge, null)).first()[0] == 65 * transfer.MIB


def test_delete_batches_have_no_single_task(spark):
    keys = spark.range(2500).select(F.format_string("k%05d", "id").alias("key"))
    got = transfer.delete_batches(keys).groupBy("batch").agg(F.count("*").alias("n"), F.min("key"), F.max("key")).orderBy("batch").collect()
    assert [r.n for r in got] == [1000, 1000, 500] and got[1][2] == "k01000"


def test_rules_by_prefix_lengths(spark):
    objects = spark.createDataFrame([("a/b",), ("a",), ("b",)], "key string")
    found = rules.matched(objects, spark.createDataFrame([("1", "a"), ("2", None), ("3", "a/b/c")], "rule_id string, prefix string"))
    assert sorted((r.key, r.rule_id) for r in found.collect()) == [("a", "1"), ("a", "2"), ("a/b", "1"), ("a/b", "2"), ("b", "2")]
    assert rules.matched(objects, spark.createDataFrame([], "rule_id string, prefix string")).isEmpty()


def test_event_patterns(spark):
    match = lambda e, p: spark.range(1).select(rules.event_matches(F.lit(e), F.lit(p))).first()[0]
    assert match("s3:ObjectCreated:Put", "s3:ObjectCreated:*") and not match("s3:aXb", "s3:a_b") and match("s3:a_b", "s3:a_b")


def test_filter_and_lock(spark):
    value = lambda c: spark.range(1).select(c).first()[0]
    t, f = F.lit(True), F.lit(False)
    assert value(rules.filter_error(t, f, f)) is None and value(rules.filter_error(t, t, t)) == "filter" and value(rules.filter_error(f, f, f)) == "filter"
    assert value(rules.retain_until(F.expr("timestamp_ntz'2024-02-29 01:00:00'"), F.lit(None), F.lit(1))).isoformat() == "2025-02-28T01:00:00"
    assert value(rules.retain_until(F.expr("timestamp_ntz'2024-02-29 01:00:00'"), F.lit(1), F.lit(1))) is None


def test_policy_form():
    with pytest.raises(ValueError):
        PostPolicy().equals("bucket", "x")
    with pytest.raises(ValueError):
        PostPolicy().content_length(2, 1)
    with pytest.raises(ValueError):
        PostPolicy().equals("lang", "en").accepts(length="size")


def test_object_urls(spark):
    value = lambda **k: spark.range(1).select(object_url("h", F.lit("a.b"), F.lit("k k"), **k)).first()[0]
    assert value() == "https://h/a.b/k%20k" and value(tls=False) == "http://a.b.h/k%20k"


def test_listing_source(spark, tmp_path):
    for p in ("a/1.txt", "a/b/2.txt", "c/3.txt", "top.txt"):
        os.makedirs(tmp_path / os.path.dirname(p), exist_ok=True)
        (tmp_path / p).write_text(p)
    listing_source.register(spark)
    found = spark.read.format("object_listing").option("path", str(tmp_path)).load()
    assert sorted((r.key, r.size) for r in found.collect()) == [("a/1.txt", 7), ("a/b/2.txt", 9), ("c/3.txt", 7), ("top.txt", 7)]
    assert sorted(r.key for r in found.where(F.col("key").startswith("a/")).collect()) == ["a/1.txt", "a/b/2.txt"]
    assert sorted(r.key for r in found.where(F.col("key").startswith("a/b")).collect()) == ["a/b/2.txt"]


def notice(key, name, time, sequencer):
    return '{"Records":[{"eventName":"%s","eventTime":"%s","s3":{"bucket":{"name":"b"},"object":{"key":"%s","sequencer":"%s"}}}]}' % (name, time, key, sequencer)


def test_notification_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    lines = [notice("a+b", "s3:ObjectCreated:Put", f"2024-01-01T00:0{i}:30Z", f"A{i}") for i in range(6)] + ["", "  "] + [notice("c", "s3:ObjectRemoved:Delete", "2024-01-01T00:02:00.5Z", "1")]
    (source / "x.json").write_text("\n".join(lines))
    batch = notifications.records(notifications.lines(spark, str(source)))
    assert batch.count() == 7 and batch.where("key = 'a b'").count() == 6
    assert {(r.key, r.sequencer) for r in notifications.last_by_sequencer(batch).collect()} == {("a b", "A5"), ("c", "1")}
    want = {tuple(r) for r in notifications.tumbling(batch, "2 minutes").collect()}
    stream = notifications.tumbling(notifications.records(notifications.lines(spark, str(source), streaming=True)), "2 minutes", late="1 minute")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("counted").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {tuple(r) for r in spark.table("counted").collect()} == want


def test_malformed_notification(spark, tmp_path):
    (tmp_path / "x.json").write_text("{nope")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        notifications.records(notifications.lines(spark, str(tmp_path))).collect()
