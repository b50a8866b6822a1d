"""License scans: TF-IDF cosine of passages to templates, and inheritance from the nearest ancestor directory.

Passages are every line, and for each template every run of as many words as it has, over line ends: so wrapped headers, notices in prose
and whole license files are found.  Lines with a license identifier are passages, too.  A passage's sparse TF-IDF vector is compared with the template's; document frequencies of the
templates' words are counted over all texts.  A bound from sums over whole slices leaves out passages that can't be near a template.
A text that mostly is a license, or has one and a license file's name, is a license file of its directory; texts without a license of their own
get that of the nearest directory above them that has a license file, by a join on paths.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.arrowtext import ALNUM, LOWER, append_columns, text_bytes, text_slices, word_hashes, word_spans
from shoal.llm.storage import stored

#: Public license notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
#: Compared with whole lines only: a few words in prose can be near them by chance.
TITLES = (
    ("Apache-2.0", "Apache License Version 2.0"),
    ("Apache-2.0", "Apache License 2.0"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
#: Least cosine of a license notice; share of a text's words, in notices, of a license file.
NEAR, FILE_SHARE = 0.75, 0.5
#: Names of license files, in any case and with any ending.
FILE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|copyright|unlicense)([-._][^/]*)?$"
#: A line that names its license exactly; what a license's name may end with.
IDENTIFIER = re.compile(rb"spdx-license-identifier:[ \t]*\(?([a-z0-9.+-]+)")
IDENTIFIER_ENDS = re.compile(r"(-only|-or-later|\+)$")
#: Folders with a license that are sent to every task at most; beyond that rows meet them by a shuffle, each folder's rows dealt to so many keys.
BROADCAST_FOLDERS, SALTS = 100_000, 32

FIELDS = [
    T.StructField("license", T.StringType()),
    T.StructField("similarity", T.DoubleType()),
    T.StructField("line", T.LongType()),
    T.StructField("licenses", T.StringType()),
    T.StructField("license_file", T.BooleanType()),
]
_LINE = np.ones(256, bool)
_LINE[10] = False


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, offsets of texts, hash and start of each word, first word of each text."""
    data, offsets = text_bytes(texts)
    data = LOWER[data] if len(data) else data
    starts, ends, first = word_spans(data, offsets, ALNUM)
    return data, offsets, word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64), starts, first


class Vocabulary:
    """Words of the templates, as sorted hashes."""

    def __init__(self, templates):
        self.counts = []
        for _, text in templates:
            self.counts.append(Counter(_words(pa.array([text]))[2].tolist()))
        self.hashes = np.array(sorted(set().union(*self.counts)), np.uint64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word in the vocabulary, -1 without one."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


def document_frequencies(df: DataFrame, text: str, vocabulary: Vocabulary) -> tuple[int, np.ndarray]:
    """The number of texts, and of those with each template word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary.hashes) + 1, np.int64)
        for part in text_slices(batches, "t"):
            _, _, hashes, _, first = _words(part.column(0))
            word = vocabulary.find(hashes)
            row = np.repeat(np.arange(part.num_rows), np.diff(first))[word >= 0]
            pairs = np.unique(row * len(vocabulary.hashes) + word[word >= 0])
            total[:-1] += np.bincount(pairs % max(1, len(vocabulary.hashes)), minlength=len(vocabulary.hashes))
            total[-1] += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), pa.array(total)], names=["word", "n"])

    rows = df.select(F.col(f"`{text}`").cast("string").alias("t")).mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row for each template word
    count = np.zeros(len(vocabulary.hashes) + 1, np.int64)
    for r in rows:
        count[r["word"]] = r["n"]
    return int(count[-1]), count[:-1]


def full_texts() -> tuple[tuple[str, str], ...]:
    """The texts of whole licenses, read on the driver."""
    return tuple((f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt")))


def _sums(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[0.0], np.cumsum(x)])


def _apart(passing: list[tuple[float, int]], length: int) -> list[int]:
    """Starts of the nearest passages of one length that don't overlap."""
    taken: list[int] = []
    for _, a in sorted(passing, key=lambda x: (-round(x[0], 9), x[1])):
        k = bisect(taken, a)
        if (not k or a - taken[k - 1] >= length) and (k == len(taken) or taken[k] - a >= length):
            taken.insert(k, a)
    return taken


def notices(df: DataFrame, *, text: str = "text", keep: list[str] | None = None, templates=TEMPLATES, titles=TITLES, full=None, near: float = NEAR, file_share: float = FILE_SHARE) -> DataFrame:
    """Adds, for every whole text, its nearest ``license`` with ``similarity`` and ``line`` (from 1), all ``licenses`` by name, and whether it is a ``license_file``.

    Without a passage of cosine ``near`` or more these are null, 0, null, null and false; so for null and empty texts. Of equal cosines the first line counts, then the first
    template. Of overlapping passages of several licenses the nearest counts, of equal ones the longest. A line with the identifier of a known license has cosine 1.
    Words are runs of ASCII letters, digits and other characters beyond ASCII; repeated rows are compared each, an empty table gives no rows. ``full``: whole license texts, ``full_texts`` by default; a text
    with less than half the words of a template is no passage for it but by its lines. ``keep``: the columns that stay, all by default; one that is named as a result gives way to it.
    """
    every = [*templates, *titles, *(full_texts() if full is None else full)]
    by_line, by_window = range(len(templates) + len(titles)), [i for i in range(len(every)) if not len(templates) <= i < len(templates) + len(titles)]
    vocabulary = Vocabulary(every)
    texts, frequency = document_frequencies(df, text, vocabulary)
    idf = np.log((1 + texts) / (1 + frequency)) + 1
    other = math.log(1 + texts) + 1  # of words that no template has
    weight = dict(zip(vocabulary.hashes.tolist(), idf.tolist(), strict=True))
    vectors = []
    for counts in vocabulary.counts:
        v = {w: n * weight[w] for w, n in counts.items()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1.0
        vectors.append({w: x / size for w, x in v.items()})
    names = [name for name, _ in every]
    lengths = [sum(c.values()) for c in vocabulary.counts]
    # by place in the vocabulary, and 0 for a word outside: what a word adds to the dot product
    adds = [np.array([t.get(w, 0.0) * weight[w] for w in vocabulary.hashes.tolist()] + [0.0]) for t in vectors]
    by_name: dict[str, int] = {}
    for i, name in enumerate(names):
        by_name.setdefault(name.lower(), i)
    often = sorted({w for i in by_window for w, n in vocabulary.counts[i].most_common(8) if n > 9})

    def compute(texts: pa.Array) -> list[pa.Array]:
        data, offsets, hashes, starts, first = _words(texts)
        n = len(texts)
        passages: list[list[tuple[float, int, int, int]]] = [[] for _ in range(n)]
        if len(hashes):
            word = vocabulary.find(hashes)
            weights = np.append(idf, other)[word]
            squares = _sums(weights**2)
            row = np.repeat(np.arange(n), np.diff(first))
            line_starts, _, _ = word_spans(data, offsets, _LINE)
            lines = np.searchsorted(np.searchsorted(line_starts, starts, "right") - 1, np.arange(len(line_starts) + 1))
            lines = np.stack([lines[:-1], lines[1:]])[:, np.diff(lines) > 0]
            repeats = [(_sums(hashes == np.uint64(w)), weight[w] ** 2) for w in often]

            def maybe(i: int, sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                """Passages that can be near: a vector is at least as long as if no word came twice, but for those that templates often have."""
                dot = sums[b] - sums[a] + 1e-6
                k = np.flatnonzero((dot > 2e-6) & (dot**2 >= near**2 * (squares[b] - squares[a])))
                a, b, dot = a[k], b[k], dot[k]
                if lengths[i] > 100 and len(k):
                    least = squares[b] - squares[a]
                    for count, square in repeats:
                        c = count[b] - count[a]
                        least += (c * c - c) * square
                    k = dot**2 >= near**2 * least * (1 - 1e-9)
                    a, b = a[k], b[k]
                return a, b

            def cosine(i: int, a: int, b: int) -> float:
                v = {x: c * weight.get(x, other) for x, c in Counter(hashes[a:b].tolist()).items()}
                return sum(v.get(x, 0.0) * y for x, y in vectors[i].items()) / math.sqrt(sum(x * x for x in v.values()))

            def add(i: int, a: int, b: int) -> None:
                c = cosine(i, a, b)
                if c >= near:
                    own = np.flatnonzero(adds[i][word[a:b]])
                    passages[row[a]].append((round(min(c, 1.0), 9), a + int(own[0]), a + int(own[-1]) + 1, i))

            for m in IDENTIFIER.finditer(data.tobytes()):
                i = by_name.get(IDENTIFIER_ENDS.sub("", m[1].decode()))
                a, b = np.searchsorted(starts, [m.start(), m.end()])
                if i is not None and row[a] == row[b - 1]:
                    passages[row[a]].append((1.0, int(a), int(b), i))

            def slid(i: int, at: list[int], length: int) -> Iterator[tuple[float, int]]:
                """Cosines of windows, in order, by counts that move along."""
                counts: dict[int, int] = {}
                lo = hi = base = 0
                ids: list[int] = []
                own: list[float] = []
                dots: list[float] = []
                total = dot = 0.0
                for k, a in enumerate(at):
                    if not k or a >= hi:
                        end = k
                        while end + 1 < len(at) and at[end + 1] < at[end] + length:
                            end += 1
                        base = lo = hi = a
                        span = slice(a, at[end] + length)
                        ids, own, dots = hashes[span].tolist(), (weights[span] ** 2).tolist(), adds[i][word[span]].tolist()
                        counts, total, dot = {}, 0.0, 0.0
                    while hi < a + length:
                        j = hi - base
                        c = counts.get(ids[j], 0)
                        counts[ids[j]] = c + 1
                        total += (2 * c + 1) * own[j]
                        dot += dots[j]
                        hi += 1
                    while lo < a:
                        j = lo - base
                        c = counts[ids[j]]
                        counts[ids[j]] = c - 1
                        total -= (2 * c - 1) * own[j]
                        dot -= dots[j]
                        lo += 1
                    yield dot / math.sqrt(total), a

            for i in range(len(every)):
                sums = _sums(adds[i][word])
                if i in by_line:
                    for a, b in zip(*(x.tolist() for x in maybe(i, sums, *lines)), strict=True):
                        add(i, a, b)
                if i in by_window:
                    size = lengths[i]
                    a = np.flatnonzero(np.arange(len(row)) + size <= first[row + 1])
                    a, _ = maybe(i, sums, a, a + size)
                    passing = [(c, x) for c, x in slid(i, a.tolist(), size) if c >= near - 1e-9]
                    for r in sorted({int(row[x]) for _, x in passing}):
                        for x in _apart([y for y in passing if first[r] <= y[1] < first[r + 1]], size):
                            add(i, x, x + size)
                    short = np.flatnonzero((np.diff(first) < size) & (2 * np.diff(first) >= size))
                    for a, b in zip(*(x.tolist() for x in maybe(i, sums, first[short], first[short + 1])), strict=True):
                        add(i, a, b)
        words = np.diff(first)
        found: list[list[tuple[float, int, int, int]]] = []
        share = []
        for r, some in enumerate(passages):
            owner = np.full(words[r] if some else 0, -1)
            kept = []
            for p in sorted(some, key=lambda p: (-p[0], p[1] - p[2], p[1], p[3])):
                a, b, name = p[1] - first[r], p[2] - first[r], names.index(names[p[3]])
                if ((owner[a:b] == -1) | (owner[a:b] == name)).all():
                    owner[a:b] = name
                    kept.append((p[0], 1 + int((data[offsets[r] : starts[p[1]]] == 10).sum()), p[3]))
            found.append(kept)
            share.append(int((owner >= 0).sum()))
        best = [min(x, key=lambda y: (-y[0], y[1], y[2])) if x else None for x in found]
        return [
            pa.array([names[b[2]] if b else None for b in best], pa.string()),
            pa.array([b[0] if b else 0.0 for b in best], pa.float64()),
            pa.array([b[1] if b else None for b in best], pa.int64()),
            pa.array([",".join(sorted({names[y[2]] for y in x})) if x else None for x in found], pa.string()),
            pa.array([bool(x) and share[i] >= file_share * words[i] for i, x in enumerate(found)], pa.bool_()),
        ]

    return append_columns(df, text, compute, FIELDS, df.columns if keep is None else keep)


def inherited(found: DataFrame, *, path: str = "path") -> DataFrame:
    """Adds ``origin`` (own, inherited or null) and ``license_from``, the directory; ``license`` is then also that inherited.

    A text with a license whose path has the name of a license file is a license file, too. A directory's license is that of most of its license files, the first by name of several.
    Directories above are looked up from the nearest; the root is "". Only distinct directories are expanded to those above them. A null path inherits nothing.
    ``found`` is what ``notices`` returns, stored (else it is computed for each step); columns of any name stay.
    """
    named = {c: f"c{i}" for i, c in enumerate(found.columns)}
    own = [F.col(f"`{c}`").alias(n) for c, n in named.items()]
    place, license, file = named[path], named["license"], named["license_file"]
    rows = found.select(*own, F.regexp_replace(F.col(f"`{path}`"), "/?[^/]*$", "").alias("own folder"))
    is_file = F.col(license).isNotNull() & (F.col(file) | F.col(place).rlike(FILE_NAMES))
    votes = rows.where(is_file & F.col("own folder").isNotNull()).groupBy("own folder", license).agg(F.count("*").alias("n"))
    given = votes.groupBy(F.col("own folder").alias("above")).agg(F.min_by(license, F.struct(-F.col("n"), F.col(license))).alias("given"))
    folders = rows.select(F.col("own folder").alias("folder")).dropna().distinct()
    parts = F.filter(F.split("folder", "/"), lambda x: x != "")
    chain = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    ancestors = folders.select("folder", F.posexplode(chain).alias("depth", "above"))
    nearest = stored(ancestors.join(given, "above").groupBy("folder").agg(F.max(F.struct("depth", "above", "given")).alias("nearest")))
    if nearest.count() <= BROADCAST_FOLDERS:
        joined = rows.join(F.broadcast(nearest), F.col("own folder") == F.col("folder"), "left")
    else:
        salted = nearest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = rows.withColumn("own salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, (F.col("own folder") == F.col("folder")) & (F.col("own salt") == F.col("salt")), "left")
    mine = F.col(license).isNotNull()
    columns = [F.coalesce(license, "nearest.given").alias(c) if c == "license" else F.col(n).alias(c) for c, n in named.items() if c not in ("origin", "license_from")]
    return joined.select(*columns, F.when(mine, "own").when(F.col("nearest").isNotNull(), "inherited").alias("origin"), F.when(~mine, F.col("nearest.above")).alias("license_from"))


def scan(df: DataFrame, *, text: str = "text", path: str = "path", keep: list[str] | None = None) -> DataFrame:
    """``notices`` of all texts, and ``inherited`` from the directories of their paths. ``keep``: the columns that stay, all by default; one that is named as a result gives way to it."""
    keep = df.columns if keep is None else keep
    results = {f.name for f in FIELDS} | {"origin", "license_from"}
    placed = df.withColumn("path of the text", F.col(f"`{path}`"))
    found = stored(notices(placed, text=text, keep=[*dict.fromkeys(c for c in keep if c not in results), "path of the text"]))
    return inherited(found, path="path of the text").drop("path of the text")
