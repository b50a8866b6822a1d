"""A quality classifier: a generalised additive model with pairwise interactions.

Features of a text are binned; each feature has a table of scores by bin, and so have some pairs of features.  Training goes
round the features and adds, again and again, a small step of a shallow tree of the loss's gradient to each table; then
the pairs whose cells explain most of what is left are boosted alike.  A score is the logistic of a sum of table look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.arrowtext import NOT_SPACE, append_columns, mixed, text_bytes, word_hashes, word_spans
from shoal.llm.sampling import hash_bound

#: Labelled rows that are learned from, at most: those whose hashed ids are least.
SAMPLE = 20_000
BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, PAIRS, RATE, LEAVES, LEAST = 32, 8, 250, 100, 6, 0.1, 3, 8
THRESHOLD = 0.3

FEATURES = (
    "log_words", "word_length", "upper", "symbols", "exclamations", "bars", "digits", "punctuation", "non_ascii",
    "lines", "duplicate_lines", "distinct_words", "same_as_before", "repeated_triples", "longest_word", "most_frequent_word",
)


def _marks(characters: bytes) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[list(characters)] = True
    return marks


_UPPER, _SYMBOLS, _BANG, _BAR, _DIGITS, _POINTS = _marks(bytes(range(0x41, 0x5B))), _marks(b"#*$%&<>@^~\\{}[]="), _marks(b"!"), _marks(b"|"), _marks(b"0123456789"), _marks(b".,;:?")
_LINE = np.ones(256, bool)
_LINE[10] = False


def _repeats(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row: its distinct keys, keys that occur more than once (all of them), and the count of the most frequent one."""
    if not len(keys):
        return np.zeros(n), np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, rows))
    k, r = keys[order], rows[order]
    new = np.r_[True, (k[1:] != k[:-1]) | (r[1:] != r[:-1])]
    at = np.flatnonzero(new)
    size = np.diff(np.r_[at, len(k)])
    most = np.zeros(n, np.int64)
    np.maximum.at(most, r[at], size)
    return np.bincount(r[at], minlength=n), np.bincount(r[at], weights=np.where(size > 1, size, 0), minlength=n), most


def features(texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each whole text; of a null or empty one all are 0."""
    data, offsets = text_bytes(texts)
    n = len(texts)
    starts, ends, first = word_spans(data, offsets, NOT_SPACE)
    words = np.diff(first)
    rows = np.repeat(np.arange(n), words)

    def count(marks: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(marks[data]) if len(data) else np.zeros(0, np.int64)
        return np.diff(np.searchsorted(at, offsets))

    per_word = 1 / np.maximum(words, 1)
    size = np.bincount(rows, weights=ends - starts, minlength=n)
    per_byte = 1 / np.maximum(size, 1)
    hashes = word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    distinct, _, most = _repeats(hashes, rows, n)
    same = np.zeros(len(rows))
    triple, triple_rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(rows) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    if len(rows) > 2:
        with np.errstate(over="ignore"):
            triple = mixed(mixed(mixed(hashes[:-2]) + hashes[1:-1]) + hashes[2:])
        inside = rows[2:] == rows[:-2]
        triple, triple_rows = triple[inside], rows[2:][inside]
    _, repeated, _ = _repeats(triple, triple_rows, n)
    line_start, line_end, line_first = word_spans(data, offsets, _LINE)
    lines = np.diff(line_first)
    line_rows = np.repeat(np.arange(n), lines)
    different, _, _ = _repeats(word_hashes(data, line_start, line_end) if len(line_start) else np.zeros(0, np.uint64), line_rows, n)
    longest = np.zeros(n)
    np.maximum.at(longest, rows, ends - starts)
    columns = [
        np.log1p(words), size * per_word, count(_UPPER) * per_byte, count(_SYMBOLS) * per_word, count(_BANG) * per_word, count(_BAR) * per_word,
        count(_DIGITS) * per_byte, count(_POINTS) * per_word, count(np.arange(256) >= 0x80) * per_byte, lines * per_word,
        1 - different / np.maximum(lines, 1), distinct * per_word, np.bincount(rows, weights=same, minlength=n) * per_word,
        repeated / np.maximum(words - 2, 1), longest, most * per_word,
    ]
    columns[10][lines == 0] = 0
    return np.stack(columns, axis=1).astype(np.float64)


@dataclass
class Model:
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)  # inner bin edges of each feature
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.edges:
            for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
                total += table[np.searchsorted(edges, x[:, j], "right")]
            coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], "right") for p in self.pairs for j in p}
            for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
                total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def _step(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray, leaves: int) -> np.ndarray:
    """A tree over ordered bins: splits the interval with the most gain until it has so many leaves; the Newton step of each bin."""
    g, h, c = (np.r_[0, np.cumsum(x)] for x in (gradient, weight, count))
    parts = [(0, len(gradient))]

    def value(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1)

    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for i, (a, b) in enumerate(parts):
            at = np.arange(a + 1, b)
            at = at[(c[at] - c[a] >= LEAST) & (c[b] - c[at] >= LEAST)]
            if len(at):
                gain = value(a, at) + value(at, b) - value(a, b)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], i, int(at[k]))
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(gradient))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1)
    return out


def _cells(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, float]:
    """The best cross of one cut in each direction: the Newton step of each cell, and its gain."""
    box = lambda x: np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    g, h, c = box(gradient), box(weight), box(count)
    rows, cols = gradient.shape
    best, out = 0.0, np.zeros_like(gradient)
    for i in range(1, rows):
        for j in range(1, cols):
            cut = [(0, i, 0, j), (0, i, j, cols), (i, rows, 0, j), (i, rows, j, cols)]
            take = lambda x, k: x[k[1], k[3]] - x[k[0], k[3]] - x[k[1], k[2]] + x[k[0], k[2]]
            if min(take(c, k) for k in cut) < LEAST:
                continue
            gain = sum(take(g, k) ** 2 / (take(h, k) + 1) for k in cut) - g[-1, -1] ** 2 / (h[-1, -1] + 1)
            if gain > best:
                best = gain
                for k in cut:
                    out[k[0] : k[1], k[2] : k[3]] = take(g, k) / (take(h, k) + 1)
    return out, best


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Fits the model to features and 0/1 labels. Without rows of both labels the score is a constant: the share of label 1, or 1/2 without rows."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(base=float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    n = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(n)]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables, strict=True)]
    total = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for j in range(n):
            p = 1 / (1 + np.exp(-total))
            size = len(model.tables[j])
            step = RATE * _step(np.bincount(bins[j], weights=y - p, minlength=size), np.bincount(bins[j], weights=p * (1 - p), minlength=size), counts[j], LEAVES)
            model.tables[j] += step
            total += step[bins[j]]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(n)]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.pair_edges)]

    def grid(a: int, b: int, weights: np.ndarray | None) -> np.ndarray:
        shape = len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1
        return np.bincount(coarse[a] * shape[1] + coarse[b], weights=weights, minlength=shape[0] * shape[1]).reshape(shape).astype(float)

    p = 1 / (1 + np.exp(-total))
    gains = {(a, b): _cells(grid(a, b, y - p), grid(a, b, p * (1 - p)), grid(a, b, None))[1] for a in range(n) for b in range(a + 1, n)}
    model.pairs = [k for k in sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS] if gains[k] > 0]
    model.pair_tables = [np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            p = 1 / (1 + np.exp(-total))
            step = RATE * _cells(grid(a, b, y - p), grid(a, b, p * (1 - p)), grid(a, b, None))[0]
            model.pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return model


def labelled(df: DataFrame, labels: DataFrame, *, doc: str = "doc_id", text: str = "text", label: str = "quality", where: Column | None = None, most: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded sample of the labelled rows. Of several labels of a document the largest counts; null ones don't."""
    marks = labels.select(F.col(f"`{doc}`").alias(doc), F.col(f"`{label}`").cast("int").alias("y")).dropna()
    marks = (marks if where is None else marks.where(where)).groupBy(doc).agg(F.max("y").alias("y"))
    near = marks.where(F.xxhash64(doc) <= hash_bound(most, marks.count()))  # else each task would send ``most`` rows to one
    chosen = F.broadcast(near.orderBy(F.xxhash64(doc), doc).limit(most))  # so many ids at most
    rows = df.select(F.col(f"`{doc}`").alias(doc), F.col(f"`{text}`").alias("t")).join(chosen, doc)

    def compute(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(list(features(texts)), pa.list_(pa.float64()))]

    got = append_columns(rows, "t", compute, [T.StructField("x", T.ArrayType(T.DoubleType()))], [doc, "y"]).dropDuplicates([doc]).orderBy(doc).collect()
    return np.array([r["x"] for r in got], float).reshape(len(got), len(FEATURES)), np.array([r["y"] > 0 for r in got], float)


def _score_columns(model: Model, df: DataFrame):
    shared = df.sparkSession.sparkContext.broadcast(model)

    def compute(texts: pa.Array) -> list[pa.Array]:
        score = shared.value.score(features(texts))
        return [pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32), pa.int32()), pa.array(score >= THRESHOLD, pa.bool_())]

    return compute, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("accepted", T.BooleanType())]


def score(df: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``score`` and ``predicted`` (1 from ``THRESHOLD`` on) of every whole text. Null and empty texts are scored too.

    ``keep``: the columns that stay, all by default; one that is named as a result gives way to it.
    """
    compute, fields = _score_columns(model, df)
    return append_columns(df, text, lambda t: compute(t)[:2], fields[:2], df.columns if keep is None else keep)


def accept(df: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows that the model predicts to be of quality, with their own columns, in one pass."""
    compute, fields = _score_columns(model, df)
    own = df.select(*[F.col(f"`{c}`").alias(f"own {i}") for i, c in enumerate(df.columns)])
    kept = append_columns(own, f"own {df.columns.index(text)}", lambda t: compute(t)[2:], fields[2:], own.columns, where="accepted")
    return kept.select(*[F.col(f"`own {i}`").alias(c) for i, c in enumerate(df.columns)])
