"""Functions against known answers and properties."""

import zlib

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoal.functions import checksums, text, validate


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


#: base64 of the digests of "hello world" and of nothing.
KNOWN = {"MD5": "XrY7u+Ae7tCTyyK7j1rNww==", "XXHASH64": "RatnNLIeaWg=", "XXHASH3": "1Eex6kDmmIs=", "XXHASH128": "340J6T+HSQCpm4d1zBW2xw=="}


def test_known_checksums(spark):
    for algorithm, want in KNOWN.items():
        assert one(spark, checksums.checksum(algorithm, F.lit("hello world"))) == want
    assert one(spark, checksums.crc32(F.lit(""))) == "AAAAAA=="
    assert len(one(spark, checksums.sha512(F.lit("x")))) == 88
    with pytest.raises(ValueError):
        checksums.checksum("nope", F.lit(""))


def test_crcs_of_check_string():
    assert checksums.Crc(*checksums.CRC32C).many([b"123456789", b"", b"12"]) [0] == 0xE3069283
    assert checksums.Crc(*checksums.CRC64NVME).many([b"123456789"]) == [0xAE8B14860A799888]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=1500), max_size=6))
def test_crc_in_pieces(rows):
    zip_crc = checksums.Crc(0xEDB88320, 32)
    assert zip_crc.many(rows) == [zlib.crc32(r) for r in rows]
    wide = checksums.Crc(*checksums.CRC64NVME)
    assert wide.many(rows) == [wide.one(r) for r in rows]


def test_null_checksums(spark):
    rows = spark.createDataFrame([(None,), ("a",)], "t string").select(checksums.crc32c("t").alias("a"), checksums.xxhash64("t").alias("b"), checksums.md5("t").alias("c")).collect()
    assert tuple(rows[0]) == (None, None, None)
    import base64

    assert rows[1]["b"] == base64.b64encode(xxhash.xxh64(b"a").digest()).decode()


def test_tags(spark):
    assert one(spark, text.parse_tags(F.lit("a=1&b&a=2&c=x%20y+z"))) == {"a": "2", "b": "", "c": "x y+z"}
    assert one(spark, text.parse_tags(F.lit("a=1=2"))) is None
    assert one(spark, text.parse_tags(F.lit(""))) == {"": ""}
    assert one(spark, text.encode_tags(F.create_map(F.lit("b c"), F.lit("1"), F.lit("a"), F.lit("&")))) == "a=%26&b%20c=1"


def test_codecs(spark):
    assert one(spark, text.url_encode(F.lit("a b+c/*~é"))) == "a%20b%2Bc%2F%2A~%C3%A9"
    assert one(spark, text.encode_key(F.lit("a b+c/d"))) == "a%20b%2Bc/d"
    assert one(spark, text.url_decode(F.lit("a+b%20c"))) == "a b c"
    assert [one(spark, text.trim_quotes(F.lit(x))) for x in ('"a"', '"', "a", '""')] == ["a", '"', "a", ""]
    assert one(spark, text.collapse_spaces(F.lit("  a   b "))) == "a b"


def test_times(spark):
    t = F.lit("2024-01-05 01:02:03.045").cast("timestamp")
    assert one(spark, text.format_http_date(t)) == "Fri, 5 Jan 2024 01:02:03 GMT"
    assert one(spark, text.format_iso8601(t)) == "2024-01-05T01:02:03.045Z"
    assert one(spark, text.format_amz_date(t)) == "20240105T010203Z" and one(spark, text.format_signer_date(t)) == "20240105"
    assert one(spark, text.parse_http_date(F.lit("Fri, 5 Jan 2024 01:02:03 GMT"))) is not None
    assert one(spark, text.parse_iso8601(F.lit("yesterday"))) is None


def test_validators(spark):
    strict = lambda x: one(spark, validate.bucket_name_error(F.lit(x)))
    assert [strict(x) for x in ("abc", " abc ", "ab", "1.2.3.4", "a..b", "Abc", "xn--abc", "", None)] == [None, None, "too_short", "ip_address", "successive_characters", "characters", "prefix_xn", "empty", "empty"]
    assert one(spark, validate.bucket_name_error(F.lit("My_Bucket:1"), strict=False)) is None
    assert one(spark, validate.object_key_error(F.lit("é" * 513))) == "too_long"
    assert one(spark, validate.is_invalid_region(F.lit("us-east-1"))) is False
    assert one(spark, validate.parse_bool(F.lit("TRUE"))) is True and one(spark, validate.parse_bool(F.lit("1"))) is None
    assert one(spark, validate.metadata_key_error(F.lit("x-amz-meta-a"))) is None
    assert one(spark, validate.annotation_error(F.lit(0))) == "empty"
