"""Byte-level BPE: encoding by an exchange of distinct words, decoding by a table of token bytes.

Each match of the pattern is encoded separately, as without special tokens.  Every distinct match of the corpus is encoded once, and
its ids come back to all its places; see ``wordblocks``.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.arrowtext import give_back
from shoal.llm.wordblocks import ragged, word_values

_encoders: dict = {}
#: Ids of a batch of decoded texts, bytes that one numpy pass decodes, and words whose ids one pass puts in place.
IDS, PASS_BYTES, PLACES = 200_000, 250_000, 250_000
_ENCODED = pa.schema([("doc", pa.int64()), ("ids", pa.list_(pa.int32()))])


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a line for each token, its bytes in base64 and its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def ranks_digest(ranks: dict[bytes, int]) -> str:
    """A digest of a whole vocabulary."""
    return hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()


def _encoder(key: str, ranks: dict[bytes, int]):
    """An encoder of whole words, once a process for each vocabulary."""
    if key not in _encoders:
        import tiktoken

        _encoders.clear()
        _encoders[key] = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, *, doc: str = "doc_id", text: str = "text", ids: str = "ids", buckets: int | None = None) -> DataFrame:
    """(doc, ids) of each row: the token ids of its whole text.

    A null or empty text has none, however long a text is it is encoded whole; repeated rows are encoded each, rows without an id too; an empty table gives no rows.
    Other columns are left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary: of fixed size
    key = ranks_digest(ranks)

    def work(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encode, size, flat = _encoder(key, shared.value).encode_ordinary, array("q"), array("i")
        for w in words:
            found = encode(w)
            size.append(len(found))
            flat.extend(found)
        return np.array(size, np.int64), np.array(flat, np.int64)

    def finish(docs: list[int], counts: np.ndarray, place: np.ndarray, values: np.ndarray, offsets: np.ndarray) -> pa.Table:
        """By runs of texts with a bounded number of words, each a batch of its own: the ids of a whole block take some ten times its bytes on the way."""
        size, ends, batches, at = np.diff(offsets), np.cumsum(counts), [], 0
        while at < len(docs):
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + PLACES, "right")))
            own = place[before : ends[upto - 1]]
            rows = np.r_[0, np.cumsum(size[own])][np.r_[0, ends[at:upto] - before]]
            flat = pa.array(ragged(values, offsets, own).astype(np.int32))
            batches.append(pa.RecordBatch.from_arrays([pa.array(docs[at:upto], pa.int64()), pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), flat)], schema=_ENCODED))
            at = upto
        return pa.Table.from_batches(batches, schema=_ENCODED)

    found = word_values(df, doc, text, pattern, work, finish, "doc bigint, ids array<int>", buckets)
    return found.select(F.col("doc").alias(doc), F.col("ids").alias(ids))


def token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens by id, and their offsets; ids that aren't used have no bytes."""
    most = max(ranks.values(), default=-1)
    by_id = [b""] * (most + 1)
    for token, rank in ranks.items():
        by_id[rank] = token
    return np.frombuffer(b"".join(by_id), np.uint8), np.r_[0, np.cumsum([len(x) for x in by_id])].astype(np.int64)


def token_bytes(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids one after another, and where each id's begin. By passes of bounded size: one takes some thirty times its bytes on the way."""
    ends = np.zeros(len(ids) + 1, np.int64)
    np.cumsum((offsets[1:] - offsets[:-1])[ids], out=ends[1:])
    out, at = np.empty(int(ends[-1]), np.uint8), 0
    while at < len(ids):
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + PASS_BYTES, "right")) - 1)
        out[ends[at] : ends[upto]] = ragged(data, offsets, ids[at:upto])
        at = upto
    return out, ends


def decode(df: DataFrame, ranks: dict[bytes, int], *, ids: str = "ids", decoded: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """Adds the bytes of each row's ids: joins every id with the token-byte table, which all tasks have. Null ids have no bytes; an unknown id is an error.

    ``keep``: the columns that stay, all by default; one that is named as the result gives way to it.
    """
    shared = df.sparkSession.sparkContext.broadcast(token_table(ranks))
    keep = [c for c in (df.columns if keep is None else keep) if c != decoded]
    own = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], *[F.col(f"`{ids}`").alias("i")][: ids not in keep])  # ids that stay are sent once
    at_ids = keep.index(ids) if ids in keep else len(keep)
    out = T.StructType([*[own.schema[f"k{i}"] for i in range(len(keep))], T.StructField("b", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, offsets = shared.value
        _encoders.clear()  # of a step before, in the same worker
        for batch in batches:
            lists = batch.column(at_ids)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends, at = np.cumsum(sizes), 0
            while at < batch.num_rows:
                upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + IDS, "right")))
                part = lists.slice(at, upto - at)
                flat = part.flatten().to_numpy(zero_copy_only=False)
                if len(flat) and (flat.min() < 0 or flat.max() >= len(offsets) - 1):
                    raise ValueError("an id isn't in the vocabulary")
                found, size = token_bytes(data, offsets, flat)
                rows = size[np.r_[0, np.cumsum(sizes[at:upto])]].astype(np.int32)
                joined = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(rows), pa.py_buffer(found)])
                yield pa.RecordBatch.from_arrays([*[c.slice(at, upto - at) for c in batch.columns[: len(keep)]], joined], names=out.names)
                at = upto
        give_back()

    return own.mapInArrow(run, out).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("b").alias(decoded))


def digests(encoded: DataFrame, ranks: dict[bytes, int], *, doc: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc, n_tokens, ids_sha256, decoded_sha256): of the ids in decimal with a space between, and of the bytes that they decode to."""
    texts = F.array_join(F.col(ids).cast("array<string>"), " ")
    named = encoded.select(doc, F.size(ids).cast("bigint").alias("n_tokens"), F.sha2(texts, 256).alias("ids_sha256"), ids)
    return decode(named, ranks, ids=ids, keep=[doc, "n_tokens", "ids_sha256"]).select(doc, "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
