"""Benchmark decontamination by suffix arrays over the training texts.

Every slice of a training partition is a shard.  Its words become integers, a suffix array of the
words is sorted, and every suffix (window) of the benchmark items is binary-searched in it: that gives all
places where ``window`` consecutive item words occur verbatim, from which the matches are
extended to their longest.  The shards need no shuffle; the benchmark is the stated query set, and goes to the
tasks in blocks of a checked size.

A shard's array only has suffixes that a window can start: a run of words, each pair of which follows each other in some
item, long enough for the shortest window.  That is exact, and leaves little of ordinary text to sort.

Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.arrowtext import ALNUM, LOWER, append_columns, text_bytes, word_hashes, word_spans

#: Words of a window.
WINDOW = 13
#: A document is contaminated if at least this share of its words is hit.
SHARE = 0.05
#: Bytes of benchmark text in a block; each block is a broadcast of its own.
BLOCK_BYTES = 32_000_000

SCAN_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("longest_match", T.LongType()),
    T.StructField("longest_at", T.LongType()),
    T.StructField("contaminated", T.BooleanType()),
]


class Words:
    """The words of a slice of texts: hashes, and the first word of each row."""

    def __init__(self, texts: pa.Array):
        data, offsets = text_bytes(texts)
        data = LOWER[data] if len(data) else data
        starts, ends, self.first = word_spans(data, offsets, ALNUM)
        self.hashes = word_hashes(data, starts, ends)


class QueryBlock:
    """The windows of a block of benchmark items, in the order in which shards are searched."""

    def __init__(self, items: list[str | None], texts: pa.Array, window: int):
        words = Words(texts)
        self.items, self.window = items, window
        self.vocabulary, ids = np.unique(words.hashes, return_inverse=True)
        self.ids = (ids + 1).astype(np.int64)  # 0 stands for the end of a run
        self.marks = np.zeros(1 << 20, bool)
        self.marks[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True
        row = np.repeat(np.arange(len(items)), np.diff(words.first))
        pairs = (self.ids[:-1] << 32 | self.ids[1:])[row[:-1] == row[1:]] if len(row) else np.zeros(0, np.int64)
        self.pairs = np.unique(pairs)
        at, owner, size = [], [], []
        for i in range(len(items)):
            a, b = words.first[i], words.first[i + 1]
            if b > a:
                n = max(1, b - a - window + 1)
                at.append(np.arange(a, a + n))
                owner.append(np.full(n, i))
                size.append(np.full(n, min(window, b - a)))
        self.at, self.owner, self.size = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at, owner, size))
        self.end = words.first[1:][self.owner] if len(self.at) else self.at
        self.shortest = int(self.size.min()) if len(self.size) else 0
        self.low, self.high = (suffix_keys(self.ids, self.at, self.size, window, fill) for fill in (0, 255))


def suffix_keys(ids: np.ndarray, at: np.ndarray, size: np.ndarray, window: int, fill: int) -> np.ndarray:
    """The first ``size`` words from each place as byte strings that sort as the words do; further words are filled."""
    step = np.arange(window)
    inside = step[None, :] < size[:, None]
    words = np.where(inside, ids[np.minimum(at[:, None] + step[None, :], max(len(ids) - 1, 0))] if len(ids) else 0, -1 if fill else 0)
    return np.ascontiguousarray(words.astype(">i4")).view(f"S{4 * window}").reshape(-1)


def search(words: Words, block: QueryBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All places of a block's windows in a shard: window, first word, words of the window, words of the longest match from there."""
    none = np.zeros(0, np.int64)
    if not len(block.at) or not len(words.hashes):
        return none, none, none, none
    ids = np.zeros(len(words.hashes), np.int64)
    maybe = np.flatnonzero(block.marks[(words.hashes >> np.uint64(44)).astype(np.int64)])
    found = np.searchsorted(block.vocabulary, words.hashes[maybe])
    found[found == len(block.vocabulary)] = 0
    same = block.vocabulary[found] == words.hashes[maybe]
    ids[maybe[same]] = found[same] + 1
    # runs of words in which each pair occurs in an item
    n = len(ids)
    linked = np.zeros(n, bool)  # with the word before it
    both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0)) + 1
    if len(both) and len(block.pairs):
        key = ids[both - 1] << 32 | ids[both]
        slot = np.minimum(np.searchsorted(block.pairs, key), len(block.pairs) - 1)
        linked[both[block.pairs[slot] == key]] = True
    first = words.first[:-1]
    linked[first[first < n]] = False
    run = np.flatnonzero(~linked)
    length = np.diff(np.append(run, n))
    use = (length >= block.shortest) & (ids[run] > 0)
    run, length = run[use], length[use]
    if not len(run):
        return none, none, none, none
    rest = np.repeat(run + length, length)
    place = rest - np.repeat(np.cumsum(length), length) + np.arange(int(length.sum()))
    keys = suffix_keys(ids, place, np.minimum(rest - place, block.window), block.window, 0)
    array = np.argsort(keys, kind="stable")
    keys = keys[array]
    lo, hi = np.searchsorted(keys, block.low, "left"), np.searchsorted(keys, block.high, "right")
    count = np.maximum(hi - lo, 0)
    query = np.repeat(np.arange(len(count)), count)
    spot = array[np.repeat(hi - np.cumsum(count), count) + np.arange(int(count.sum()))]
    at, size = place[spot], block.size[query]
    # a short item's key may also be met by a run that ends early: its fill is 0
    whole = rest[spot] - at >= size
    query, at, size, end = query[whole], at[whole], size[whole], rest[spot][whole]
    longest, more = size.copy(), np.arange(len(at))
    while len(more):
        a, b = at[more] + longest[more], block.at[query[more]] + longest[more]
        ok = (a < end[more]) & (b < block.end[query[more]])
        more, a, b = more[ok], a[ok], b[ok]
        more = more[ids[a] == block.ids[b]]
        longest[more] += 1
    return query, at, size, longest


def blocks_of(benchmark: DataFrame, item: str, text: str, window: int, most: int = BLOCK_BYTES) -> Iterator[QueryBlock]:
    """Reads the query set once, a block at a time; the driver never has more than a block of its texts."""
    items: list[str | None] = []
    texts: list[str] = []
    size = 0
    rows = benchmark.select(F.col(f"`{item}`").cast("string").alias("i"), F.col(f"`{text}`").cast("string").alias("t")).where("t is not null")
    for r in rows.toLocalIterator():
        items.append(r["i"])
        texts.append(r["t"])
        size += len(r["t"].encode())
        if size >= most:
            yield QueryBlock(items, pa.array(texts, pa.string()), window)
            items, texts, size = [], [], 0
    if items:
        yield QueryBlock(items, pa.array(texts, pa.string()), window)


def _scan(df: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, keep: list[str], window: int, share: tuple[int, int], most: int, where: str | None) -> DataFrame:
    context = df.sparkSession.sparkContext
    blocks = [context.broadcast(b) for b in blocks_of(benchmark, item, item_text, window, most)]
    times, over = share

    def compute(texts: pa.Array) -> list[pa.Array]:
        words = Words(texts)
        rows = len(texts)
        n_words = np.diff(words.first)
        cover = np.zeros(len(words.hashes) + 1, np.int64)
        longest, where_longest = np.zeros(rows, np.int64), np.full(rows, -1, np.int64)
        items: dict[int, set[str]] = {}
        for each in blocks:
            block = each.value
            query, at, size, extent = search(words, block)
            if not len(query):
                continue
            np.add.at(cover, at, 1)
            np.add.at(cover, at + size, -1)
            row = np.searchsorted(words.first, at, "right") - 1
            order = np.lexsort((at, -extent, row))
            head = order[np.r_[True, np.diff(row[order]) > 0]]
            best, spot = longest[row[head]], where_longest[row[head]]
            better = head[(extent[head] > best) | (extent[head] == best) & (at[head] - words.first[row[head]] < spot)]
            longest[row[better]] = extent[better]
            where_longest[row[better]] = at[better] - words.first[row[better]]
            for r, o in np.unique(np.stack([row, block.owner[query]]), axis=1).T.tolist():
                if block.items[o] is not None:
                    items.setdefault(r, set()).add(block.items[o])
        hit = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
        n_hit = hit[words.first[1:]] - hit[words.first[:-1]]
        names = [sorted(items.get(r, ())) for r in range(rows)]
        return [
            pa.array(n_words, pa.int64()),
            pa.array(n_hit, pa.int64()),
            pa.array([len(x) for x in names], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()),
            pa.array(longest, pa.int64()),
            pa.array(where_longest, pa.int64()),
            pa.array(((n_hit > 0) & (over * n_hit >= times * n_words)) == (where is None), pa.bool_()),
        ]

    fields = [T.StructField("clean", T.BooleanType()) if where and f.name == "contaminated" else f for f in SCAN_FIELDS]
    return append_columns(df, text, compute, fields, keep, where=where)


def scan(df: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", keep: list[str] | None = None, window: int = WINDOW, share: tuple[int, int] = (1, 20), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Matches of every text with the benchmark: words, words hit, items that occur, longest match, verdict.

    An item with fewer words than ``window``, but not none, is one window. ``share`` is the least share of words hit
    of a contaminated text, as (1, 20). ``longest_at`` is the word at which the longest verbatim match starts, -1 without one;
    of several, the first.
    A null or empty text has no words and is clean; items without words match nothing, those without an id have windows that are hit, but aren't counted as items; repeated rows are scanned each;
    an empty benchmark leaves everything clean. ``keep``: the columns that stay, all by default; one that is named as a
    result gives way to it.
    """
    return _scan(df, benchmark, text, item, item_text, df.columns if keep is None else keep, window, share, block_bytes, None)


def decontaminate(df: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, share: tuple[int, int] = (1, 20), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows that ``scan`` doesn't call contaminated, with their own columns, in one pass."""
    new = {f.name for f in SCAN_FIELDS} | {"clean"}
    safe = {c: f"own {i}" for i, c in enumerate(df.columns)}
    own = df.select(*[F.col(f"`{c}`").alias(s) for c, s in safe.items()])
    assert not new & set(own.columns)
    kept = _scan(own, benchmark, safe[text], item, item_text, own.columns, window, share, block_bytes, "clean")
    return kept.select(*[F.col(f"`{s}`").alias(c) for c, s in safe.items()])
