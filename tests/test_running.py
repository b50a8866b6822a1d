"""Running sums, rolling windows, scans by blocks and checksums of chunks against plain versions."""

import base64
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shoal.operators import copies, listing, transfer
from shoal.operators.running import rolling, running
from shoal.sources import listing_source
from shoal.sources.content import CHUNKED, chunk_checksums, contents
from shoal.sources.select import scan_range

WIDE = "key string, n long, size long, `running x` string"


def plain(rows):
    out, state = {}, {}
    for key, n, size, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        place, before, last = state.get(key, (0, 0, None))
        out[key, n] = (place + 1, before, last, x)
        state[key] = (place + 1, before + (size or 0), size)
    return out


@pytest.mark.parametrize("keys", [["a"], ["a", "a", "a", "b", None], [None], list("abcdefgh")])
def test_hot_keys_run_over_ranges(spark, keys):
    pick = random.Random(len(keys))
    rows = [(pick.choice(keys), i, None if i % 13 == 0 else pick.randrange(100), "x") for i in range(500)]
    df = spark.createDataFrame(rows, WIDE).repartition(7)
    got = running(df, ["key"], [F.col("n")], sums=("size",), previous=("size",))
    assert got.columns == [*df.columns, "place", "before size", "previous size"]
    assert {(r.key, r.n): (r.place, r["before size"], r["previous size"], r["running x"]) for r in got.collect()} == plain(rows)


def test_descending_numbers_and_empty_tables(spark):
    df = spark.range(1000).select(F.col("id").alias("n"))
    got = running(df, [], [F.desc("n")])
    assert all(r.place == 1000 - r.n for r in got.collect())
    assert running(df.limit(0), [], [F.col("n")]).count() == 0
    assert transfer.delete_batches(df.limit(0).withColumn("key", F.lit("x"))).count() == 0


def test_rolling_is_a_window_by_key(spark):
    pick = random.Random(3)
    rows = [(i, pick.choice("ab"), pick.randrange(40) * 250_000) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, key string, at long").withColumn("ts", F.timestamp_micros("at"))
    got = {r.id: (r.n, r.total) for r in rolling(df, ["key"], "ts", 1_000_000, n=F.count("*"), total=F.sum("id")).collect()}
    inside = {i: [j for j, other, u in rows if other == key and t - 1_000_000 < u <= t] for i, key, t in rows}
    assert got == {i: (len(x), sum(x)) for i, x in inside.items()}


def test_scan_ranges_over_blocks(spark, tmp_path):
    lines = [("é" * (i % 5) + f"line {i}" + "\r" * (i % 2)).encode() for i in range(400)]
    (tmp_path / "x.txt").write_bytes(b"\n".join(lines))
    (tmp_path / "y.txt").write_bytes(b"one\n\ntwo\xff\n")
    want, at = [], 0
    for x in lines:
        want, at = [*want, (at, x)], at + len(x) + 1
    want += [(0, b"one"), (4, b""), (5, b"two\xff")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        for start, end in ((0, 10**6), (0, 0), (100, 3000), (511, 513)):
            got = scan_range(spark, str(tmp_path), start, end).select("offset", F.col("record").cast("binary").alias("r")).collect()
            assert sorted((r.offset, bytes(r.r)) for r in got) == sorted(x for x in want if start <= x[0] <= end)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_checksums_of_chunks(spark):
    whole = {i: bytes(random.Random(i).randbytes(i * 37)) for i in range(1, 30)}
    rows = [(i, at, data[at : at + 10]) for i, data in whole.items() for at in range(0, len(data), 10)] + [(99, 0, None)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "id long, at long, data binary")
    digest = {"SHA256": lambda d: hashlib.sha256(d).digest(), "CRC32": lambda d: zlib.crc32(d).to_bytes(4, "big")}
    for name, f in digest.items():
        got = {r.id: r.checksum for r in chunk_checksums(df, name, by="id", order="at", content="data").collect()}
        assert got == {i: base64.b64encode(f(d)).decode() for i, d in (whole | {99: b""}).items()}
    for name in CHUNKED:
        assert chunk_checksums(df.limit(0), name, by="id", order="at", content="data").count() == 0
    with pytest.raises(ValueError):
        chunk_checksums(df, "CRC64NVME", by="id", order="at", content="data")


def test_contents_are_whole_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(b"\x00\n\xff")
    (tmp_path / "empty").write_bytes(b"")
    assert sorted((r.path.rpartition("/")[2], r.size, bytes(r.content)) for r in contents(spark, str(tmp_path)).collect()) == [("x", 3, b"\x00\n\xff")]
    listing_source.register(spark)
    files = spark.read.format("object_listing").option("path", str(tmp_path)).load()
    assert sorted((r.key, r.size) for r in files.collect()) == [("a/x", 3), ("empty", 0)]


def test_copies_beyond_a_part_are_composed(spark):
    gib = 1 << 30
    objects = spark.createDataFrame([("small", 10, "e"), ("large", 6 * gib, "f"), ("none", 0, "g")], "key string, size long, etag string").withColumn("last_modified", F.lit("2024-01-01").cast("timestamp_ntz"))
    asked = [("small", "a", None, None, "COPY"), ("large", "b", None, None, None), ("large", "c", None, None, "COPY"), ("small", "d", 4, None, None), ("small", "e", 4, 7, None), ("none", "f", None, None, None), ("gone", "g", None, None, None), ("small", "h", 10, None, None)]
    requests = spark.createDataFrame(asked, "source string, target string, offset long, length long, directive string")
    got = {r.target: (r.bytes, r.parts, r.how, r.error) for r in copies.copies(requests, objects).collect()}
    bad = lambda e: (None, None, None, e)
    assert got == {"a": (10, 1, "copy", None), "b": (6 * gib, 2, "compose", None), "c": bad("directive"), "d": (6, 1, "compose", None), "e": bad("range"), "f": (0, 1, "copy", None), "g": bad("not_found"), "h": bad("offset")}


def test_kinds_of_listings(spark):
    objects = spark.createDataFrame([("a/x", 1), ("b", 2)], "key string, size long")
    versions = spark.createDataFrame([("a/x", "1", False, 1), ("a/x", "2", True, None), ("b", "3", False, 2)], "key string, version_id string, is_delete_marker boolean, size long")
    seen = lambda **o: sorted((r.key, r.version_id) for r in listing.list_objects(objects, versions, **o).collect())
    assert [k for k, _ in seen()] == ["a/", "b"]
    assert [k for k, _ in seen(include_versions=True, use_v1=True, recursive=True)] == ["a/x", "b"]
    assert seen(include_versions=True, recursive=True) == [("a/x", "1"), ("a/x", "2"), ("b", "3")]
    assert [k for k, _ in seen(include_versions=True)] == ["a/", "b"]
    assert seen(include_versions=True, recursive=True, start_after="a/x", key_marker="") == [("a/x", "1"), ("a/x", "2"), ("b", "3")]
