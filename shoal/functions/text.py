"""Codecs of keys, URLs, tags, headers and times, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_decode(c: Column | str) -> Column:
    """Form decoding: a plus sign is a space. A malformed code gives null."""
    return F.try_url_decode(_column(c))


def url_encode(c: Column | str) -> Column:
    """Percent encoding of all but letters, digits and ``-._~``."""
    x = F.url_encode(_column(c))
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def encode_key(c: Column | str) -> Column:
    """An object key in a URL: encoded, with its slashes."""
    return F.replace(url_encode(c), F.lit("%2F"), F.lit("/"))


def parse_tags(c: Column | str) -> Column:
    """The map of a tag string. Percent decoding only; a missing value is empty, the last of equal keys counts, more than one ``=`` in a tag or a malformed code gives null."""
    decode = lambda x: F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B")))
    pairs = F.transform(F.split(_column(c), "&"), lambda t: F.split(t, "="))
    entry = lambda p: F.struct(decode(p[0]).alias("key"), decode(F.coalesce(F.get(p, F.lit(1)), F.lit(""))).alias("value"))
    last = lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: decode(q[0]) == decode(p[0]))
    good = lambda p: (F.size(p) <= 2) & F.forall(p, lambda x: decode(x).isNotNull())
    return F.when(F.forall(pairs, good), F.map_from_entries(F.transform(F.filter(pairs, last), entry)))


def encode_tags(c: Column | str) -> Column:
    """The tag string of a map, by key."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(_column(c))), lambda e: F.concat(url_encode(e["key"]), F.lit("="), url_encode(e["value"]))), "&")


def query_string(c: Column | str) -> Column:
    """The query string of an array of (key, value), in its order."""
    return F.array_join(F.transform(_column(c), lambda e: F.concat(url_encode(e["key"]), F.lit("="), url_encode(e["value"]))), "&")


def b64_encode(c: Column | str) -> Column:
    return F.base64(_column(c).cast("binary"))


def hex_encode(c: Column | str) -> Column:
    return F.lower(F.hex(_column(c).cast("binary")))


def uint32(c: Column | str) -> Column:
    """The big-endian number of the first four bytes; null with fewer."""
    x = F.substring(_column(c).cast("binary"), 1, 4)
    return F.when(F.octet_length(x) == 4, F.conv(F.hex(x), 16, 10).cast("bigint"))


def xml_escape(c: Column | str) -> Column:
    """Text as it stands in an XML element or attribute."""
    x = _column(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def quoted_etag(c: Column | str) -> Column:
    """A tag as a condition names it: in quotes, but for the star that any tag matches."""
    x = _column(c)
    return F.when(x == "*", x).otherwise(F.concat(F.lit('"'), x, F.lit('"')))


def trim_quotes(c: Column | str) -> Column:
    """Without one pair of double quotes, if there is one at both ends."""
    x = _column(c)
    return F.when((F.length(x) >= 2) & x.startswith('"') & x.endswith('"'), F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(x)


def collapse_spaces(c: Column | str) -> Column:
    return F.regexp_replace(F.trim(_column(c)), " {2,}", " ")


_SECONDS, _MILLIS = "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def parse_iso8601(c: Column | str) -> Column:
    """A time with or without milliseconds; null for anything else."""
    x = _column(c)
    return F.coalesce(F.try_to_timestamp(x, F.lit(_MILLIS)), F.try_to_timestamp(x, F.lit(_SECONDS)))


def parse_rfc3339(c: Column | str) -> Column:
    """A time with an offset or ``Z``, with or without parts of a second; null for anything else."""
    x = _column(c)
    shape = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
    return F.when(x.rlike(shape), F.upper(x).try_cast("timestamp"))


def format_iso8601(c: Column | str) -> Column:
    return F.date_format(_column(c), _MILLIS)


def format_amz_date(c: Column | str) -> Column:
    return F.date_format(_column(c), "yyyyMMdd'T'HHmmss'Z'")


def format_signer_date(c: Column | str) -> Column:
    return F.date_format(_column(c), "yyyyMMdd")


def format_http_date(c: Column | str) -> Column:
    """The day of the month without a leading zero."""
    return F.date_format(_column(c), "EEE, d MMM yyyy HH:mm:ss 'GMT'")


def parse_http_date(c: Column | str) -> Column:
    return F.try_to_timestamp(F.substring_index(_column(c), ", ", -1), F.lit("d MMM yyyy HH:mm:ss 'GMT'"))


def object_url(endpoint: str, bucket: Column | str, key: Column | str, *, tls: bool = True, virtual_host: bool = True) -> Column:
    """The URL of an object; the bucket is part of the path with ``virtual_host`` off, or if it has a dot and TLS is on."""
    b, scheme = _column(bucket), "https://" if tls else "http://"
    path = F.lit(not virtual_host) | (b.contains(".") & F.lit(tls))
    return F.when(path, F.concat(F.lit(f"{scheme}{endpoint}/"), b, F.lit("/"), encode_key(key))).otherwise(F.concat(F.lit(scheme), b, F.lit(f".{endpoint}/"), encode_key(key)))
