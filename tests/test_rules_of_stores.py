"""Golden cases of names, parts, conditions, pages and policies, by the public rules of object stores."""

import gzip

import pytest
from pyspark.sql import functions as F

from shoal.functions import text, validate
from shoal.operators import conditions, listing, rules, transfer
from shoal.sources.select import CsvInput, SelectRequest
from shoal.streaming import notifications

MIB = transfer.MIB


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


@pytest.mark.parametrize(
    "name, error",
    [("192.168.1.1", "ip_address"), ("999.999.999.999", None), ("10.0.01.1", None), ("1.2.3", None), ("\tabc\n", None), (" abc ", None), ("ab", "too_short"), (None, "empty"), (" \t ", "empty"), ("a.-b", "successive_characters"), ("Abc", "characters"), ("xn--abc", "prefix_xn"), ("abc-s3alias", "suffix_alias"), ("256.1.1.1", None), ("1.1.1.255", "ip_address")],
)
def test_bucket_names(spark, name, error):
    assert one(spark, validate.bucket_name_error(F.lit(name).cast("string"))) == (error,)


def test_labels(spark):
    hosts = {"a.b-c.d": True, "a..b": False, "-a.b": False, "a_.b": False, "x" * 63: True, "x" * 64: False, "": False, "a b": False}
    assert one(spark, *[validate.is_hostname(F.lit(h)) for h in hosts]) == tuple(hosts.values())
    regions = {"us-east-1": False, "-east": True, "a.b": True, "": True, "x" * 64: True}
    assert one(spark, *[validate.is_invalid_region(F.lit(r)) for r in regions]) == tuple(regions.values())


def test_part_sizes(spark):
    cases = [(10, 8 * MIB, 8 * MIB, 1), (10, None, 10, 1), (0, None, 0, 1), (None, 8 * MIB, 8 * MIB, None), (100 * MIB, None, 64 * MIB, 2), (1 << 40, None, 105 * MIB, 9987), (17 * MIB, 8 * MIB, 8 * MIB, 3)]
    df = spark.createDataFrame(cases, "size long, part long, wanted long, parts long")
    got = df.select("wanted", "parts", transfer.planned_part(F.col("size"), F.col("part")).alias("p"), transfer.planned_parts(F.col("size"), F.col("part")).alias("n")).collect()
    assert [(r.p, r.n) for r in got] == [(r.wanted, r.parts) for r in got]


def test_what_is_left_of_a_source(spark):
    """Before the last source, what is left after whole parts must have the smallest size too."""
    rows = [(1, 1, 17 * MIB), (1, 2, 8 * MIB), (2, 1, 17 * MIB), (3, 1, 16 * MIB), (3, 2, 1), (4, 1, 22 * MIB), (4, 2, 1)]
    df = spark.createDataFrame(rows, "target long, n long, size long").withColumns({"offset": F.lit(None).cast("long"), "length": F.lit(None).cast("long")})
    got = {(r.target, r.n): r.error for r in transfer.compose(df, by="target", order="n", part=8 * MIB).collect()}
    assert got == {(1, 1): "last_part_too_small", (1, 2): None, (2, 1): None, (3, 1): None, (3, 2): None, (4, 1): None, (4, 2): None}


def test_malformed_codes_are_null(spark):
    assert one(spark, text.url_decode(F.lit("100%")), text.url_decode(F.lit("a+b%20c")), text.parse_tags(F.lit("a=1&b=100%"))["a"], text.parse_tags(F.lit("a=1&b=%41"))["b"]) == (None, "a b c", None, "A")
    lines = spark.createDataFrame([('{"Records":[{"eventName":"x","s3":{"object":{"key":"100%"}}}]}',)], "value string")
    assert [r.key for r in notifications.records(lines).collect()] == [None]


def test_small_functions(spark):
    got = one(spark, text.uint32(F.unhex(F.lit("00000102ff"))), text.uint32(F.unhex(F.lit("0001"))), text.b64_encode(F.lit("hello world")), text.hex_encode(F.lit("Az")), text.xml_escape(F.lit("<a b='c' & \">")), text.query_string(F.array(F.struct(F.lit("a b").alias("key"), F.lit("1/2").alias("value")), F.struct(F.lit("c").alias("key"), F.lit("").alias("value")))))
    assert got == (258, None, "aGVsbG8gd29ybGQ=", "417a", "&lt;a b=&apos;c&apos; &amp; &quot;&gt;", "a%20b=1%2F2&c=")


def test_conditions(spark):
    tag, time, none = F.lit("t"), F.lit("2024-01-02").cast("timestamp_ntz"), F.lit(None).cast("string")
    day = lambda d: F.lit(f"2024-01-{d:02}").cast("timestamp_ntz")
    f = conditions.failed
    got = one(spark, f(tag, time, match=F.lit("t")), f(tag, time, match=F.lit("x")), f(tag, time, match=F.lit("*")), f(none, time, match=F.lit("*")), f(none, time, none_match=F.lit("*")), f(tag, time, none_match=F.lit("*")), f(tag, time, modified_since=day(2)), f(tag, time, modified_since=day(1)), f(tag, time, unmodified_since=day(1)), f(tag, time, match=none, none_match=F.lit("x")))
    assert got == (None, "if_match", None, "if_match", None, "if_none_match", "if_modified_since", None, "if_unmodified_since", None)


def test_pages_of_fifteen_keys(spark):
    df = spark.createDataFrame([(f"max-keys-test-{i:03}", i, False) for i in range(15)], "key string, size long, is_prefix boolean")
    got = [[r.key for r in rows] for rows in listing.pages(df, 5)]
    assert [len(p) for p in got] == [5, 5, 5] and [k for p in got for k in p] == [f"max-keys-test-{i:03}" for i in range(15)]
    assert [len(p) for p in listing.pages(df, 4)] == [4, 4, 4, 3] and [len(p) for p in listing.pages(df.limit(0), 4)] == []
    first = listing.page_with_state(df, limit=5).orderBy("key").collect()
    assert all(r.is_truncated and r.next_marker == "max-keys-test-004" for r in first)


def test_version_pages(spark):
    import datetime

    at = lambda d: datetime.datetime(2024, 1, d)
    rows = [("a", "1", at(1)), ("a", "2", at(3)), ("a", "3", at(2)), ("b", "4", at(1)), ("b", "5", at(1)), ("c", "6", at(9))]
    df = spark.createDataFrame(rows, "key string, version_id string, last_modified timestamp_ntz")
    seen, markers = [], {}
    while True:
        page = listing.versions_page(df, limit=2, **markers).collect()
        seen += [r.version_id for r in page]
        if not page[0].is_truncated:
            break
        markers = {"key_marker": page[0].next_key_marker, "version_marker": page[0].next_version_marker}
    assert seen == ["2", "3", "1", "5", "4", "6"]
    assert [r.version_id for r in listing.versions_page(df, key_marker="a").collect()] == ["5", "4", "6"]


def test_policies_meet_by_equality(spark):
    requests = spark.createDataFrame([(1, "u", "s3:GetObject", "b", "b/x", False), (2, "u", "s3:PutObject", "b", "b/y", False)], "request_id long, principal string, action string, bucket string, resource string, owner boolean")
    some = spark.createDataFrame([("Allow", "*", "s3:Get*", "b/*"), ("Deny", "u", "*", "b/y")], "effect string, principal string, action string, resource string")
    many = spark.range(20_001).selectExpr("'Allow' effect", "'nobody' principal", "concat('s3:', id) action", "'*' resource")
    df = rules.policy_allowed(requests, some.union(many))
    assert {r.request_id: r.allowed for r in df.collect()} == {1: True, 2: False}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_first_rule_of_equal_priority_copies(spark):
    objects = spark.createDataFrame([("a/x",)], "key string")
    found = spark.createDataFrame([("first", "a", 5, "east", True, 1), ("second", "a/", 5, "east", True, 2)], "rule_id string, prefix string, priority int, destination string, enabled boolean, `order` int")
    assert [r.rule_id for r in rules.replication_targets(objects, found).collect()] == ["first"]


def test_declared_compression(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(gzip.compress(b"a\n1\n"))
    with pytest.raises(ValueError):
        SelectRequest("select * from S3Object", CsvInput(compression="GZIP")).rows(spark, str(tmp_path))


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from shoal.sources import storage

    class Cluster:
        class sparkContext:
            master = "spark://somewhere:7077"

        class conf:
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(RuntimeError):
        storage.new_folder(Cluster)
