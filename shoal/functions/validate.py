"""Validation predicates; each gives null for a valid value, or the name of the first rule it breaks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _first(*rules: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(broken, F.lit(name)) for broken, name in rules])


#: What a bucket's name looks like, by the public rules of object stores.
STRICT_NAME = r"^[a-z0-9][a-z0-9.\-]{1,61}[a-z0-9]$"
RELAXED_NAME = r"^[A-Za-z0-9][A-Za-z0-9.\-_:]{1,61}[A-Za-z0-9]$"


def is_ipv4(c: Column | str) -> Column:
    """Four numbers of 0 to 255, without leading zeros, with dots between."""
    octet = lambda p: p.rlike("^(0|[1-9][0-9]*)$") & F.coalesce(p.try_cast("int") <= 255, F.lit(False))
    parts = F.split(_column(c), r"\.")
    return (F.size(parts) == 4) & F.forall(parts, octet)


def bucket_name_error(c: Column | str, *, strict: bool = True) -> Column:
    """Rules of bucket names, of the name without white space around it; lengths are in bytes."""
    x = F.regexp_replace(F.coalesce(_column(c), F.lit("")), r"(?U)^\s+|\s+$", "")
    size = F.octet_length(x)
    rules = [(size == 0, "empty"), (size < 3, "too_short"), (size > 63, "too_long"), (is_ipv4(x), "ip_address"), (x.rlike(r"\.\.|\.-|-\."), "successive_characters")]
    if not strict:
        return _first(*rules, (~x.rlike(RELAXED_NAME), "characters"))
    return _first(*rules, (~x.rlike(STRICT_NAME), "characters"), (x.startswith("xn--"), "prefix_xn"), (x.startswith("sthree-"), "prefix_sthree"), (x.endswith("-s3alias"), "suffix_alias"))


def object_key_error(c: Column | str) -> Column:
    x = F.coalesce(_column(c), F.lit(""))
    return _first((F.octet_length(x) < 1, "empty"), (F.octet_length(x) > 1024, "too_long"))


def is_label(c: Column | str) -> Column:
    """1 to 63 letters, digits, hyphens and underscores, of which the last two are neither first nor last."""
    x = _column(c)
    return F.length(x).between(1, 63) & ~x.rlike("[^A-Za-z0-9_-]") & ~F.substring(x, 1, 1).isin("-", "_") & ~F.substring(x, -1, 1).isin("-", "_")


def is_hostname(c: Column | str) -> Column:
    """Labels with dots between."""
    return F.forall(F.split(_column(c), r"\."), is_label)


def is_invalid_region(c: Column | str) -> Column:
    return ~is_label(c)


def parse_bool(c: Column | str) -> Column:
    x = F.lower(_column(c))
    return F.when(x == "true", True).when(x == "false", False)


def metadata_key_error(c: Column | str) -> Column:
    x = F.coalesce(_column(c), F.lit(""))
    return _first((x == "", "empty"), (~x.startswith("x-amz-meta-"), "prefix"))


def annotation_error(size: Column | str) -> Column:
    return _first((_column(size) < 1, "empty"), (_column(size) > 1 << 20, "too_large"))
