"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings.

A candidate is a long run of key-like characters.  For each character class, the entropy of a window moves along it by
incremental counts; windows above the class's threshold join to spans.  Places that an allow-list pattern matches are left out with what is
near them in the same part of the candidate, and spans inside a pattern's span are suppressed.  Runs of characters are found for all texts of a slice at once; only texts with
a keyword or a candidate are looked at one by one.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.arrowtext import LOWER, append_columns, text_bytes, word_spans

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST, CANDIDATE_LEAST = 12, 18, 16, 20

#: Found in strings that look random but are no secrets.
ALLOWED = (
    r"(?i)(?<![0-9a-f])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![0-9a-f])",
    r"(?i)example|sample|placeholder|changeme|your[_-]",
    r"(?i)abcdefghijkl|0123456789ab|1234567890",
    r"(.)\1{7,}",
)
#: Between the parts of a candidate; so many characters of a part around an allowed place are left out with it.
SEPARATORS, NEIGHBOURS = "/_=-+", 20


@dataclass(frozen=True)
class CharacterClass:
    """Characters that a window may have, patterns it must have, its length and its least entropy in bits."""

    name: str
    characters: str
    needs: tuple[str, ...]
    window: int
    least: float


CLASSES = (
    CharacterClass("hex", "0123456789abcdefABCDEF", ("[0-9]", "[a-fA-F]"), 24, 3.2),
    CharacterClass("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", ("[0-9]", "[A-Z]"), 20, 3.6),
    CharacterClass("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", ("[0-9]", "[A-Z]", "[a-z]"), 20, 3.75),
    CharacterClass("base36", "abcdefghijklmnopqrstuvwxyz0123456789", ("[0-9]", "[g-z]"), 20, 3.6),
)


def _marks(characters: bytes) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[list(characters)] = True
    return marks


_HEX, _ACCESS = _marks(b"0123456789abcdef"), _marks(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_CANDIDATE = _marks("".join(c.characters for c in CLASSES).encode())


def entropy_spans(text: str, kind: CharacterClass) -> list[tuple[int, int]]:
    """Joined windows of a class whose entropy is high enough, in a candidate string."""
    found: list[list[int]] = []
    n = kind.window
    cost = [0.0] + [c * math.log2(c) for c in range(1, n + 1)]
    for run in re.finditer(f"[{re.escape(kind.characters)}]{{{n},}}", text):
        a, b = run.span()
        counts: dict[str, int] = {}
        total = 0.0  # sum of c log c over the window
        for i in range(a, b):
            c = counts.get(text[i], 0)
            counts[text[i]] = c + 1
            total += cost[c + 1] - cost[c]
            if i - a >= n:
                old = text[i - n]
                c = counts[old]
                counts[old] = c - 1
                total += cost[c - 1] - cost[c]
            if i - a >= n - 1 and math.log2(n) - total / n >= kind.least:
                s = i - n + 1
                if all(re.search(x, text[s : i + 1]) for x in kind.needs):
                    if found and s <= found[-1][1]:
                        found[-1][1] = i + 1
                    else:
                        found.append([s, i + 1])
    return [(a, b) for a, b in found]


def unallowed(candidate: str, allow: list[re.Pattern]) -> list[tuple[int, int, int, int]]:
    """The pieces of a candidate outside allowed places and their neighbourhoods, as (start, end, least start, last end): a span that reaches the piece's edge goes on up to the allowed place."""
    places: list[list[int]] = []
    for x in allow:
        for m in x.finditer(candidate):
            a, b = m.span()
            left = max(candidate.rfind(c, 0, a) for c in SEPARATORS) + 1
            right = min((k for c in SEPARATORS if (k := candidate.find(c, b)) >= 0), default=len(candidate))
            places.append([max(left, a - NEIGHBOURS), min(right, b + NEIGHBOURS), a, b])
    pieces = []
    at = least = 0
    for a, b, inner, end in sorted(places):
        if a > at:
            pieces.append((at, a, least, inner))
        at, least = max(at, b), max(least, end)
    return [*pieces, (at, len(candidate), least, len(candidate))] if at < len(candidate) else pieces


def spans_of(texts: pa.Array, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> list[list[tuple[int, int, int]]]:
    """For each text its spans as (start, index of the kind, end), sorted; places are code points."""
    data, offsets = text_bytes(texts)
    spans: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    if not len(data):
        return spans
    raw = data.tobytes()
    points = np.cumsum((data & 0xC0) != 0x80)  # code points up to and with each byte
    first = np.where(offsets > 0, points[np.maximum(offsets - 1, 0)], 0)

    def runs(marks: np.ndarray, least: int):
        starts, ends, _ = word_spans(data, offsets, marks)
        long = ends - starts >= least
        starts, ends = starts[long], ends[long]
        rows = np.searchsorted(offsets, starts, "right") - 1
        return zip(rows.tolist(), starts.tolist(), ends.tolist(), (points[starts] - 1 - first[rows]).tolist(), strict=True)

    for row, a, b, at in runs(_HEX, HEX_LEAST):
        spans[row].append((at, 2, at + b - a))
    for row, a, b, at in runs(_ACCESS, ACCESS_LEAST):
        k = raw.find(b"AKIA", a, b)
        if k >= 0 and b - k >= ACCESS_LEAST:
            spans[row].append((at + k - a, 1, at + b - a))
    low = LOWER[data].tobytes()
    rows = set()
    for word in KEYWORDS:
        k = low.find(word)
        while k >= 0:
            row = int(np.searchsorted(offsets, k, "right")) - 1
            rows.add(row)
            k = low.find(word, int(offsets[row + 1]) if k + 1 < offsets[row + 1] else k + 1)
    for row in rows:
        for m in ASSIGN.finditer(raw[offsets[row] : offsets[row + 1]].decode("utf-8", "replace")):
            if len(m[2]) >= ASSIGN_LEAST:
                spans[row].append((m.start(), 0, m.end()))
    allow = [re.compile(x) for x in allowed]
    added: dict[int, list[tuple[int, int]]] = {}
    for row, a, b, at in runs(_CANDIDATE, CANDIDATE_LEAST):
        candidate = raw[a:b].decode()
        for a, b, least, last in unallowed(candidate, allow):
            for kind in classes:
                for s, e in entropy_spans(candidate[a:b], kind):
                    s, e = a + s, a + e
                    added.setdefault(row, []).append((at + (least if s == a else s), at + (last if e == b else e)))
    for row, more in added.items():
        base = list(spans[row])
        joined: list[list[int]] = []
        for a, b in sorted(more):
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(b, joined[-1][1])
            else:
                joined.append([a, b])
        spans[row] += [(a, 3, b) for a, b in joined if not any(s <= a and b <= e for s, _, e in base)]
    return [sorted(x) for x in spans]


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(df: DataFrame, *, text: str = "text", keep: list[str] | None = None, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Counts of each kind and the list of all spans (``kind:start:end``, by start and then kind) of every whole text.

    A null text counts as an empty one and has no spans. A pattern's match that is too short is used up and dropped. Repeated rows are
    scanned each. ``keep``: the columns that stay, all by default; one that is named as a result gives way to it.
    """
    names = [f"n_{k}" for k in KINDS]

    def compute(texts: pa.Array) -> list[pa.Array]:
        found = spans_of(texts, classes, allowed)
        counts = [pa.array([sum(k == i for _, k, _ in x) for x in found], pa.int64()) for i in range(len(KINDS))]
        base = [hashlib.sha256(listed([s for s in x if s[1] < 3]).encode()).hexdigest() for x in found]
        return [*counts, pa.array(base, pa.string()), pa.array([listed(x) for x in found], pa.string())]

    fields = [T.StructField(n, T.LongType()) for n in names] + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    return append_columns(df, text, compute, fields, df.columns if keep is None else keep)


def redact(df: DataFrame, *, text: str = "text", mark: str = "[secret]", classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """The same rows and columns, with each secret (overlapping spans as one) replaced by a mark. A null text stays null."""

    def compute(texts: pa.Array) -> list[pa.Array]:
        out = texts.to_pylist()
        for i, spans in enumerate(spans_of(texts, classes, allowed)):
            at, parts = 0, []
            for a, _, b in spans:
                if b > at:
                    if a >= at:
                        parts += [out[i][at:a], mark]
                    at = b
            if spans:
                out[i] = "".join([*parts, out[i][at:]])
        return [pa.array(out, pa.string())]

    own = df.select(*[F.col(f"`{c}`").alias(f"own {i}") for i, c in enumerate(df.columns)])
    source = f"own {df.columns.index(text)}"
    done = append_columns(own, source, compute, [T.StructField("redacted", T.StringType())], [c for c in own.columns if c != source])
    return done.select(*[F.col("redacted" if c == text else f"`own {i}`").alias(c) for i, c in enumerate(df.columns)])
