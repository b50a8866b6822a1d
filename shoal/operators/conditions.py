"""Conditions on an object's tag and time, for reads, copies and renames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of a failed condition; the first of several counts.
MATCH, NONE_MATCH, MODIFIED, UNMODIFIED = "if_match", "if_none_match", "if_modified_since", "if_unmodified_since"


def _names(tag: Column, wanted: Column) -> Column:
    return (wanted == "*") & tag.isNotNull() | F.coalesce(tag == wanted, F.lit(False))


def failed(tag: Column, modified: Column, *, match: Column | None = None, none_match: Column | None = None, modified_since: Column | None = None, unmodified_since: Column | None = None) -> Column:
    """The condition that an object fails, or null. A star matches any object; an object that isn't there (null tag) matches nothing; a null condition isn't one."""
    never = F.lit(False)
    rules = []
    if match is not None:
        rules.append(F.when(match.isNotNull() & ~F.coalesce(_names(tag, match), never), F.lit(MATCH)))
    if unmodified_since is not None:
        rules.append(F.when(modified > unmodified_since, F.lit(UNMODIFIED)))
    if none_match is not None:
        rules.append(F.when(none_match.isNotNull() & F.coalesce(_names(tag, none_match), never), F.lit(NONE_MATCH)))
    if modified_since is not None:
        rules.append(F.when(modified <= modified_since, F.lit(MODIFIED)))
    return F.coalesce(*rules, F.lit(None).cast("string"))
