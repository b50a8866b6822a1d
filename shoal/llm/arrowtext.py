"""Helpers shared by the text operators.

Texts reach Python as Arrow batches and are handled as one byte buffer with row offsets,
cut into slices of bounded size, so that numpy passes replace loops over rows.  A single text
longer than the bound makes a slice of its own: texts are never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one numpy pass handles.
SLICE_BYTES = 1_000_000

#: Bytes that are white space: space and 0x09-0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
NOT_SPACE = ~_SPACE
#: Digits, letters and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


_libc = ctypes.CDLL(None)


def give_back() -> None:
    """Returns freed memory to the system. Else a worker keeps its most, while it waits for tasks and others need it."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def lean(f: Callable[..., pa.Table], *args) -> pa.Table:
    """Calls a function of groups and gives back what it has freed."""
    out = f(*args)
    give_back()
    return out


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of rows with at most so many bytes in a string column, one row at least."""
    for batch in batches:
        sizes = np.diff(text_bytes(batch.column(batch.schema.get_field_index(column)))[1])
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array, and offsets of its rows in them. A null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) and not pa.types.is_large_binary(texts.type) else b"")
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    rows = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[rows[0] : rows[-1]], rows - rows[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word (longest run of bytes that ``kinds`` marks, within a row), and each row's first word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = kinds[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that all their bits depend on all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        with np.errstate(over="ignore"):
            _powers[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from one prefix sum of a polynomial over all bytes."""
    up, down = _power_tables(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(0x1F3)) * up[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def append_columns(
    df: DataFrame,
    text: str,
    compute: Callable[[pa.Array], list[pa.Array]],
    fields: list[T.StructField],
    keep: list[str],
    most: int = SLICE_BYTES,
    where: str | None = None,
) -> DataFrame:
    """Adds columns that ``compute`` derives from slices of a text column, in one pass without a shuffle.

    ``keep`` names the columns that stay; a kept column with the name of a new one gives way to it.
    ``where`` names a new boolean column: only rows for which it is true stay, and it is left out.
    """
    new = {f.name for f in fields}
    keep = [c for c in keep if c not in new]
    inner = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("t"))
    out = T.StructType([T.StructField(f"k{i}", inner.schema[f"k{i}"].dataType) for i in range(len(keep))] + [T.StructField(f"n{i}", f.dataType) for i, f in enumerate(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "t", most):
            columns = [part.column(i) for i in range(len(keep))] + list(compute(part.column(len(keep))))
            done = pa.RecordBatch.from_arrays(columns, names=[f.name for f in out])
            yield done.filter(columns[len(keep) + next(i for i, f in enumerate(fields) if f.name == where)]) if where else done
        give_back()

    got = inner.mapInArrow(run, out)
    names = [*keep, *[f.name for f in fields]]
    return got.select(*[F.col(f.name).alias(n) for f, n in zip(out, names, strict=True) if n != where])
