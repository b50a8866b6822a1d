"""Conditions of a form upload, compiled to a predicate over form rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that a policy sets itself, and none that a condition may name.
RESERVED = {"bucket", "x-amz-algorithm", "x-amz-credential", "x-amz-date", "policy", "x-amz-signature"}
_STARTS = {"key", "content-type", "cache-control", "content-disposition", "content-encoding", "expires"}


def _element(name: str) -> str:
    name = name.strip().removeprefix("$").lower()
    if not name or name in RESERVED:
        raise ValueError(f"a condition can't be on {name or 'nothing'}")
    return name


@dataclass(frozen=True)
class PostPolicy:
    equal: tuple[tuple[str, str], ...] = ()
    prefixes: tuple[tuple[str, str], ...] = ()
    length: tuple[int, int] | None = None

    def equals(self, element: str, value: str) -> PostPolicy:
        return PostPolicy((*self.equal, (_element(element), value)), self.prefixes, self.length)

    def starts_with(self, element: str, value: str) -> PostPolicy:
        if (name := _element(element)) not in _STARTS and not name.startswith("x-amz-"):
            raise ValueError(f"no prefix condition on {name}")
        return PostPolicy(self.equal, (*self.prefixes, (name, value)), self.length)

    def content_length(self, least: int, most: int) -> PostPolicy:
        if least > most:
            raise ValueError("the range of lengths is empty")
        return PostPolicy(self.equal, self.prefixes, (least, most))

    def accepts(self, *, length: str) -> Column:
        """Whether a form row, whose columns are named as the elements, meets all conditions."""
        if not any(name == "key" for name, _ in (*self.equal, *self.prefixes)):
            raise ValueError("a condition on the key is needed")
        out = F.lit(True)
        for name, value in self.equal:
            out = out & (F.col(f"`{name}`") == value)
        for name, value in self.prefixes:
            out = out & F.col(f"`{name}`").startswith(value)
        if self.length:
            out = out & F.col(length).between(*self.length)
        return F.coalesce(out, F.lit(False))
