"""Global exchange of distinct words: a function of a word is worked out once for each distinct word of a corpus.

Tasks explode texts to pre-tokens with positions, kept for many texts at once as a block: its distinct words, and at each
position the number of the word.  Distinct words go to buckets, where equal words of all blocks meet and are worked out once; the answers go
back to the blocks, which put them in the places of the words.  So a frequent word travels once a block, not once an
occurrence, and no key is hot.  Positions travel once, in the same exchange as the words: that exchange is read both
to answer words and, beside the answers, to put them in place; each block is put together by itself.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.arrowtext import give_back, lean, text_slices

#: Bytes of text, and distinct words, that end a block.
BLOCK_BYTES, BLOCK_WORDS = 8_000_000, 100_000
#: Words of a very long text that are strings at once.
WORDS = 200_000

_KINDS = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
_ROW_SQL = "key bigint, block bigint, part int, payload binary"


def _packed(x) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(x, 5))


def _unpacked(x: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(x))


def _planes(numbers: np.ndarray) -> list[bytes]:
    """Bytes of numbers by significance: the frequent small ones leave high planes almost empty."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    return [((numbers >> 8 * k) & 255).astype(np.uint8).tobytes() for k in range(width)]


def _numbers(planes: list[bytes], kind: type = np.int64) -> np.ndarray:
    out = np.frombuffer(planes[0], np.uint8).astype(kind)
    for k, plane in enumerate(planes[1:], 1):
        out |= np.frombuffer(plane, np.uint8).astype(kind) << 8 * k
    return out


def ragged(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The values of the given rows one after another, of an array of rows with these offsets."""
    size = offsets[rows + 1] - offsets[rows]
    return values[np.repeat(offsets[rows] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


def whole_word(word: bytes) -> bytes:
    return word


class Block:
    """Texts of a block: their ids and numbers of words, the distinct words, and which of them is at each place."""

    def __init__(self):
        self.docs: list[int] = []
        self.counts: list[int] = []
        self.known: dict[str, int] = {}
        self.places: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc: int, groups: Iterator[list[str]]) -> None:
        n = 0
        for words in groups:
            n += len(words)
            for w in set(words).difference(self.known):
                self.known[w] = len(self.known)
            self.places.append(np.fromiter(map(self.known.__getitem__, words), np.int32, len(words)))
        self.docs.append(doc)
        self.counts.append(n)

    def rows(self, number: int, buckets: int, shared: Callable[[bytes], bytes]) -> pa.RecordBatch:
        """Its head, under its own number, and the words of each bucket, under a negative one."""
        place = np.concatenate(self.places) if self.places else np.zeros(0, np.int32)
        # the most frequent words get the lowest numbers
        words = list(self.known)
        rank = np.argsort(-np.bincount(place, minlength=len(words)), kind="stable")
        low = np.empty(len(words), np.int32)
        low[rank] = np.arange(len(words), dtype=np.int32)
        raw = [words[i].encode("utf-8", "surrogatepass") for i in rank.tolist()]
        bucket = np.fromiter((zlib.crc32(shared(w)) % buckets for w in raw), np.int64, len(raw))
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [(number, number, -1, _packed((self.docs, self.counts, _planes(low[place]), _planes(bucket))))]
        for b in range(buckets):
            own = [raw[i] for i in order[edges[b] : edges[b + 1]].tolist()]
            if own:
                rows.append((-1 - b, number, b, _packed((_planes(np.fromiter(map(len, own), np.int64, len(own))), b"".join(own)))))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=["key", "block", "part", "payload"])


def word_values(
    df: DataFrame,
    doc: str,
    text: str,
    pattern: str,
    work: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
    finish: Callable[[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray], pa.Table],
    schema: str,
    buckets: int | None = None,
    shared: Callable[[bytes], bytes] = whole_word,
) -> DataFrame:
    """One table from all texts: ``work`` gives numbers to each of some distinct words, ``finish`` makes the rows of a block.

    ``work`` returns how many numbers each word has, and all of them one after another. ``finish`` gets the ids of the block's documents, their numbers of words,
    the word at each place, and numbers of all words with their offsets. A null text has no words. ``buckets``: those of distinct words; a bucket should hold some hundred thousand.
    Words with equal ``shared`` bytes go to one bucket.
    """
    buckets = buckets or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        compiled, number = regex.compile(pattern), TaskContext.get().partitionId() << 32

        def groups(t: str | None) -> Iterator[list[str]]:
            if t and len(t) < 4 * WORDS:
                yield compiled.findall(t)
            elif t:
                found = compiled.finditer(t)
                while words := [m[0] for m in islice(found, WORDS)]:
                    yield words

        block = Block()
        for part in text_slices(batches, "t", BLOCK_BYTES):
            for d, t in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                block.add(d, groups(t.as_py()))
            block.bytes += part.column(1).nbytes
            if block.bytes >= BLOCK_BYTES or len(block.known) >= BLOCK_WORDS:
                yield block.rows(number, buckets, shared)
                block, number = Block(), number + 1
        if block.docs:
            yield block.rows(number, buckets, shared)
        del block
        give_back()

    def answer(table: pa.Table) -> pa.Table:
        rows, asked, known = [], [], {}
        for _, block, part, payload in zip(*(c.to_pylist() for c in table.columns), strict=True):
            if part < 0:
                continue
            planes, joined = _unpacked(payload)
            ends = np.cumsum(_numbers(planes)).tolist()
            asked.append((block, part, np.fromiter((known.setdefault(joined[a:b], len(known)) for a, b in zip([0, *ends], ends, strict=False)), np.int32, len(ends))))
        if asked:
            size, flat = work([w.decode("utf-8", "surrogatepass") for w in known])
            offsets = np.r_[0, np.cumsum(size)]
            for block, part, at in asked:
                rows.append((block, part, _packed((_planes(size[at]), _planes(ragged(flat, offsets, at))))))
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(columns, _KINDS[1:], strict=True)], names=["block", "part", "payload"])

    def placed(head: bytes, parts: dict[int, bytes]) -> pa.Table:
        docs, counts, planes, bucket = _unpacked(head)
        order = np.argsort(_numbers(bucket), kind="stable")
        size = np.zeros(len(order), np.int64)
        got = [_unpacked(parts[b]) for b in sorted(parts)]
        if got:
            size[order] = np.concatenate([_numbers(s) for s, _ in got])
        by_bucket = np.concatenate([_numbers(v) for _, v in got]) if got else np.zeros(0, np.int64)
        start = np.empty(len(order) + 1, np.int64)
        start[:1] = 0
        start[1:] = np.cumsum(size[order])
        # from the order of buckets to that of numbers
        where = np.empty(len(order), np.int64)
        where[order] = np.arange(len(order))
        return finish(docs, np.array(counts, np.int64), _numbers(planes, np.int32), ragged(by_bucket, start, where), np.r_[0, np.cumsum(size)])

    def back(answers: pa.Table, sent: pa.Table) -> pa.Table:
        parts = dict(zip(answers["part"].to_pylist(), answers["payload"].to_pylist(), strict=True))
        none = np.zeros(0, np.int64)
        heads = [h for h in sent["payload"].to_pylist() if h is not None]  # one, or none for the key of a bucket
        return placed(heads[0], parts) if heads else finish([], none, none, none, np.zeros(1, np.int64))

    rows = df.select(F.col(f"`{doc}`").cast("bigint").alias("d"), F.col(f"`{text}`").cast("string").alias("t"))
    sent = rows.mapInArrow(out, _ROW_SQL).repartition("key")  # one exchange, read twice; what a reader has no use for is left out after it
    side = lambda own: sent.select("key", "block", "part", F.when(own, F.col("payload")).alias("payload"))
    answers = side(F.col("part") >= 0).groupBy("key").applyInArrow(lambda t: lean(answer, t), "block bigint, part int, payload binary")
    return answers.groupBy("block").cogroup(side(F.col("part") < 0).groupBy("key")).applyInArrow(lambda a, b: lean(back, a, b), schema)
