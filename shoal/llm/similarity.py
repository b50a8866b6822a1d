"""N-gram Jaccard join: a size-aware heavy-light set join that finds all links, as classes and components.

1. Each text becomes the set of 64-bit hashes of its word n-grams.  Equal sets are one class.
2. An n-gram of a single text can't be shared, and a text links only if three quarters of its n-grams are shared, so a first
   count of n-grams leaves few texts.  The count goes by blocks: a task sends for many texts at once one packed array to each
   hash bucket, and gets back a number for each text.
3. Among the sets that are left, n-grams are ordered from rare to frequent.  Large sets are found by scanning inverted lists of
   their rarest n-grams: as many as must hold a common one.  Small sets enumerate their subsets of a fixed size:
   two sets of ``b`` n-grams at most link only if they share a subset of ceil(3b/4).  The boundary between small and large is where the sum of subsets
   enumerated and list entries scanned is least.
4. Members of a list are compared with its leader first.  Then only pairs that no chain of links joins yet are
   compared, first with another leader, then those that are left: of a list, members outside its leader's component with all others.
   So a list of many near copies costs about as many comparisons as it has members,
   and no link between components is lost.  Before sets are compared, parity sketches tell how many n-grams they differ in at least:
   what both have cancels out, so the bound is near the truth, and pairs that can't link aren't made.  Two sets that share many lists
   are paired once, not once a list: each entry has the least hashes of its set's lists, which show that an earlier list has made the pair.

Comparisons are exact (on hashes) and run in tiles of a bounded number of sets on either side.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.arrowtext import append_columns, LOWER, NOT_SPACE, give_back, lean, mixed, text_bytes, text_slices, word_hashes, word_spans
from shoal.llm.components import components
from shoal.llm.storage import dropped, stored

WORDS, OVER, UNDER = 5, 3, 4  # words of an n-gram; linked from a similarity of OVER / UNDER on
#: Hashes in a block, and sets on either side of a tile that is compared at once.
BLOCK, CHUNK = 1_000_000, 64
#: Largest set that may count as small.
SMALL = 15
#: Bits of a parity sketch.
SKETCH = 512
#: Least hashes of a set's lists that its entries have.
FEW = 8
#: Bits of the filter that keeps most other texts from a join.
FILTER_BITS = 1 << 23


def least_overlap(n: int | np.ndarray):
    """N-grams of a set of n that a linked set must share."""
    return -(-OVER * n // UNDER)


def shingle_sets(texts: pa.Array, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all texts one after another, and how many each has.

    A text with fewer words than an n-gram has all its words as one; one without words has none.
    """
    data, offsets = text_bytes(texts)
    n = len(texts)
    data = LOWER[data] if len(data) else data
    starts, ends, first = word_spans(data, offsets, NOT_SPACE)
    words = np.diff(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    h = word_hashes(data, starts, ends)
    rows = np.repeat(np.arange(n), words)
    with np.errstate(over="ignore"):
        part, short = mixed(h), {}
        for k in range(1, width):
            for r in np.flatnonzero(words == k):
                short[r] = part[first[r]] + np.uint64(k)
            if k < len(h):
                part = mixed(part[: len(h) - k] * np.uint64(0x9E3779B97F4A7C15) + h[k:])
            else:
                part = part[:0]
        inside = rows[: len(part)] == rows[width - 1 :] if len(part) else np.zeros(0, bool)
    grams, owner = part[inside], rows[: len(part)][inside]
    if short:
        grams = np.concatenate([grams, np.array(list(short.values()), np.uint64)])
        owner = np.concatenate([owner, np.array(list(short), np.int64)])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.r_[True, (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])] if len(grams) else np.zeros(0, bool)
    grams, owner = grams[new], owner[new]
    return grams, np.bincount(owner, minlength=n)


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    return ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def _rest(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """What tells hashes of a bucket apart, in 48 bits: with 65,536 buckets or more that is the whole hash, with fewer 48 bits and those of the number of buckets."""
    return (grams & np.uint64(0xFFFFFFFF)).astype(np.uint32), ((grams >> np.uint64(32)) // np.uint64(buckets)).astype(np.uint16)


def _packed(x) -> bytes:
    return zlib.compress(pickle.dumps(x, 5), 1)


def _unpacked(x: bytes):
    return pickle.loads(zlib.decompress(x))


_ROW = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("part", pa.int32()), ("payload", pa.binary())])
_ROW_SQL = "key bigint, block bigint, part int, payload binary"


def _blocks_out(block: int, head, grams: np.ndarray, sizes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows of a block: its head, which a bucket only hands on, and the rest of its hashes for each bucket."""
    bucket = _bucket(grams, buckets)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    order = np.argsort(bucket, kind="stable")
    edges = np.r_[0, np.cumsum(np.bincount(bucket, minlength=buckets))]
    low, high = _rest(grams[order], buckets)
    del bucket
    rows = [(zlib.crc32(block.to_bytes(8, "big")) % buckets, block, -1, _packed(head))]
    for b in range(buckets):
        at = slice(edges[b], edges[b + 1])
        if at.stop > at.start:
            counts = np.bincount(owner[order[at]], minlength=len(sizes)).astype(np.uint32)
            rows.append((b, block, b, len(p := _packed(counts)).to_bytes(4, "big") + p + low[at].tobytes() + high[at].tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ROW.types, strict=True)], schema=_ROW)


def _counted(table: pa.Table, whole: bool) -> pa.Table:
    """A bucket: texts that have each hash. Back go, by block, its shared hashes by text, or if ``whole`` that number by hash."""
    out, blocks = [], []
    for key, block, part, payload in zip(*(c.to_pylist() for c in table.columns), strict=True):
        if part < 0:
            out.append((block, part, payload))
        else:
            n = int.from_bytes(payload[:4], "big")
            size = (len(payload) - 4 - n) // 6
            blocks.append((block, part, _unpacked(payload[4 : 4 + n]), np.frombuffer(payload, np.uint32, size, 4 + n).astype(np.uint64) | np.frombuffer(payload, np.uint16, size, 4 + n + 4 * size).astype(np.uint64) << np.uint64(32)))
    if blocks:
        rest = np.concatenate([b[3] for b in blocks])
        order = np.argsort(rest)
        rest = rest[order]
        at = np.flatnonzero(np.r_[True, rest[1:] != rest[:-1]])
        size = np.diff(np.r_[at, len(rest)])
        count = np.empty(len(rest), np.uint32)
        count[order] = np.repeat(size, size)
        a = 0
        for block, part, counts, own in blocks:
            mine = count[a : a + len(own)]
            a += len(own)
            owner = np.repeat(np.arange(len(counts)), counts)
            out.append((block, part, _packed(mine if whole else np.bincount(owner, weights=mine > 1, minlength=len(counts)).astype(np.uint32))))
    kinds = (_ROW.field("block").type, _ROW.field("part").type, _ROW.field("payload").type)
    columns = zip(*out, strict=True) if out else ([], [], [])
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["block", "part", "payload"])


def _by_block(table: pa.Table) -> tuple[object, dict[int, np.ndarray]]:
    """Head and answers of a block."""
    head, parts = None, {}
    for _, part, payload in zip(*(c.to_pylist() for c in table.columns), strict=True):
        if part < 0:
            head = _unpacked(payload)
        else:
            parts[part] = _unpacked(payload)
    return head, parts


def _frequencies(blocks: DataFrame, whole: bool) -> DataFrame:
    answers = blocks.groupBy("key").applyInArrow(lambda t: lean(_counted, t, whole), "block bigint, part int, payload binary")
    return answers.groupBy("block")


def _block_number(context, n: int) -> int:
    return context.partitionId() << 32 | n


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def profile(df: DataFrame, *, doc: str, text: str, width: int = WORDS, buckets: int) -> DataFrame:
    """(doc, n, digest, candidate) of each row: its n-grams, a digest of the set, and whether enough of them are shared."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, number = TaskContext.get(), 0
        docs, all_sizes, digests, all_grams, size = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            sizes = np.concatenate(all_sizes)
            return _blocks_out(_block_number(context, number), (docs, sizes, digests), np.concatenate(all_grams), sizes, buckets)

        for part in text_slices(batches, "t"):
            grams, sizes = shingle_sets(part.column(1), width)
            ends = np.cumsum(sizes)
            docs += part.column(0).to_pylist()
            digests += [_digest(grams[e - s : e]) if s else None for s, e in zip(sizes, ends, strict=True)]
            all_sizes.append(sizes)
            all_grams.append(grams)
            size += len(grams)
            if size >= BLOCK:
                yield flush()
                number += 1
                docs, all_sizes, digests, all_grams, size = [], [], [], [], 0
        if docs:
            yield flush()
        give_back()

    def back(table: pa.Table) -> pa.Table:
        (docs, sizes, digests), parts = _by_block(table)
        shared = sum((p.astype(np.int64) for p in parts.values()), np.zeros(len(docs), np.int64))
        candidate = (sizes > 0) & (shared >= least_overlap(sizes))
        return pa.table([pa.array(docs, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(candidate)], names=["doc", "n", "digest", "candidate"])

    rows = df.select(F.col(f"`{doc}`").cast("bigint").alias("d"), F.col(f"`{text}`").cast("string").alias("t"))
    return _frequencies(rows.mapInArrow(out, _ROW_SQL), False).applyInArrow(lambda t: lean(back, t), "doc bigint, n bigint, digest binary, candidate boolean")


def sets_of(df: DataFrame, chosen: DataFrame, *, doc: str, text: str, width: int = WORDS) -> DataFrame:
    """(rep, n, grams) of the chosen (rep, id, digest). Texts aren't shuffled: a fixed-size bitmap of chosen ids lets few others pass, whose sets then join."""
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    bitmap = chosen.select(place.alias("p")).groupBy(F.bitmap_bucket_number(F.col("p") + 1).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("p") + 1)).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in bitmap.collect():  # FILTER_BITS / 32768 rows of 4 KB at most
        bits[(r["k"] - 1) * 4096 : r["k"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    shared = df.sparkSession.sparkContext.broadcast(bits)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            p = batch.column(0).to_numpy(zero_copy_only=False)
            found = batch.filter(pa.array((bits[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)))
            for part in text_slices(iter([found]), "t") if found.num_rows else ():
                grams, sizes = shingle_sets(part.column(2), width)
                ends = np.cumsum(sizes)
                own = [grams[e - s : e] for s, e in zip(sizes, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(sizes, pa.int64()), pa.array(map(_digest, own), pa.binary()), pa.array([g.tobytes() for g in own], pa.binary())], names=["id", "n", "digest", "grams"])
        give_back()

    rows = df.where(F.col(f"`{doc}`").isNotNull()).select(F.col(f"`{doc}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    made = rows.select(place.alias("p"), "id", "t").mapInArrow(out, "id bigint, n bigint, digest binary, grams binary")
    return made.join(chosen, ["id", "digest"]).dropDuplicates(["rep"]).select("rep", "n", "grams")


def prefixes(sets: DataFrame, buckets: int) -> DataFrame:
    """(rep, n, rank, sketch, keys, scans, small) of each set that may link.

    ``keys``: its rarest shared n-grams, as many as must hold a common one; ``scans``: the sets that have them; ``small``: all shared ones of a small set;
    ``sketch``: by bit, whether an odd number of its n-grams fall there; ``rank``: how many sets share its n-grams on the whole, which is most at the centre of a group of near copies.
    """

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, number = TaskContext.get(), 0
        reps, grams, size = [], [], 0

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(g) for g in grams])
            joined = np.concatenate(grams)
            return _blocks_out(_block_number(context, number), (reps, sizes, joined), joined, sizes, buckets)

        for batch in batches:
            for rep, g in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                reps.append(rep)
                grams.append(np.frombuffer(g.as_buffer(), np.uint64))
                size += len(grams[-1])
                if size >= BLOCK:
                    yield flush()
                    number += 1
                    reps, grams, size = [], [], 0
        if reps:
            yield flush()
        give_back()

    def back(table: pa.Table) -> pa.Table:
        (reps, sizes, grams), parts = _by_block(table)
        count = np.zeros(len(grams), np.uint32)
        order = np.argsort(_bucket(grams, buckets), kind="stable")
        count[order] = np.concatenate([parts[b] for b in sorted(parts)])
        rows = []
        at = 0
        for rep, n in zip(reps, sizes.tolist(), strict=True):
            g, c = grams[at : at + n], count[at : at + n]
            at += n
            if (c > 1).sum() < least_overlap(n):
                continue
            rank = np.lexsort((g, c))[: n - least_overlap(n) + 1]
            rank = rank[c[rank] > 1]
            if len(rank):
                sketch = np.packbits(np.bincount((g & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1).view(np.int64)
                rows.append((rep, n, int(1000 * c.mean()), sketch, g[rank].view(np.int64), c[rank].astype(np.int64), g[c > 1].view(np.int64) if n <= SMALL else None))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()))
        columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
        return pa.table([pa.array(c, t) for c, t in zip(map(list, columns), kinds, strict=True)], names=["rep", "n", "rank", "sketch", "keys", "scans", "small"])

    return _frequencies(sets.select("rep", "grams").mapInArrow(out, _ROW_SQL), True).applyInArrow(lambda t: lean(back, t), "rep bigint, n bigint, rank bigint, sketch array<bigint>, keys array<bigint>, scans array<bigint>, small array<bigint>")


def subsets_of(n: int, boundary: int) -> int:
    """Subsets that a small set of n enumerates."""
    return sum(math.comb(n, least_overlap(b)) for b in range(n, boundary + 1) if least_overlap(b) <= n)


def boundary(found: DataFrame) -> int:
    """The largest small set, such that subsets enumerated and list entries scanned are fewest in all."""
    rows = found.where(F.col("n") <= SMALL).groupBy("n").agg(F.count("*").alias("sets"), F.sum(F.aggregate("scans", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("scans")).collect()  # SMALL rows at most
    by = {r["n"]: r for r in rows}

    def cost(b: int) -> float:
        light = sum(r["sets"] * subsets_of(n, b) for n, r in by.items() if n <= b)
        return light + sum(r["scans"] for n, r in by.items() if n >= least_overlap(b + 1))

    return min(range(SMALL + 1), key=lambda b: (cost(b), -b))


def postings(found: DataFrame, limit: int) -> DataFrame:
    """(key, rep, n, rank, sketch, few): list entries of large sets, and of small ones that may link with large ones; subsets of small sets.

    ``few``: the least hashes of the set's keys of the same sort.
    """
    few = F.slice(F.array_sort(F.transform("keys", lambda k: F.xxhash64(k))), 1, FEW).alias("few")
    each = [F.explode("keys").alias("key"), "rep", "n", "rank", "sketch", "few"]
    large = found.where(F.col("n") >= least_overlap(limit + 1)).select("keys", "rep", "n", "rank", "sketch", few).select(*each)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for n, grams in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = []
                for b in range(n, limit + 1):
                    c = least_overlap(b)
                    for subset in itertools.combinations(sorted(grams), c) if c <= len(grams) else ():
                        own.append(int.from_bytes(hashlib.blake2b(repr((b, subset)).encode(), digest_size=8).digest(), "big", signed=True))
                keys.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.list_(pa.int64())), *[batch.column(k) for k in (0, 1, 3, 4)]], names=["keys", "rep", "n", "rank", "sketch"])

    light = found.where(F.col("n") <= limit).select("rep", "n", "small", "rank", "sketch").mapInArrow(out, "keys array<bigint>, rep bigint, n bigint, rank bigint, sketch array<bigint>")
    return large.union(light.select("*", few).select(*each))


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) of pairs (a, b), from their sets.

    Pairs are kept by the least partner of ``b``, in tiles of some ``CHUNK`` sets ``a`` and ``CHUNK`` sets ``b``: a set travels once to each tile that has a pair of it, and
    no tile grows with a group.
    """
    home = pairs.groupBy("b").agg(F.min("a").alias("home"))
    homed = pairs.join(home, "b")
    tiles = lambda c: F.ceil(F.count_distinct(c) / CHUNK)
    sizes = homed.groupBy("home").agg(tiles("b").alias("down"), tiles("a").alias("across"))
    tile = F.struct("home", F.pmod(F.xxhash64("b"), "down").alias("row"), F.pmod(F.xxhash64("a"), "across").alias("column"))
    placed = stored(homed.join(sizes, "home").select(tile.alias("tile"), "a", "b"))
    grams = lambda c: sets.select(F.col("rep").alias(c), F.col("grams").alias("g"))
    members = placed.groupBy("tile", "b").agg(F.collect_set("a").alias("all")).join(grams("b"), "b").select("tile", "b", "all", "g")
    leaders = placed.select(F.col("tile").alias("tile of a"), "a").distinct().join(grams("a"), "a").select("tile of a", "a", "g")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        own = dict(zip(left.column("a").to_pylist(), (np.frombuffer(g.as_buffer(), np.uint64) for g in left.column("g")), strict=True))
        rows = []
        for b, every, g in zip(right.column("b").to_pylist(), right.column("all").to_pylist(), right.column("g"), strict=True):
            y = np.frombuffer(g.as_buffer(), np.uint64)
            for a in every:
                x = own[a]
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[at] == y).sum())
                rows.append((a, b, UNDER * both >= OVER * (len(x) + len(y) - both)))
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_()), strict=True)], names=["a", "b", "linked"])

    return leaders.groupBy("tile of a").cogroup(members.groupBy("tile")).applyInArrow(lambda x, y: lean(meet, x, y), "a bigint, b bigint, linked boolean")


def linked_components(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, label) of the sets that link, from their lists (key, rep, n, rank, sketch, few)."""
    differ = sum((F.bit_count(F.get("x.sketch", F.lit(i)).bitwiseXOR(F.get("y.sketch", F.lit(i)))) for i in range(SKETCH // 64)), F.lit(0))
    # sets of n and m n-grams that link differ in (UNDER - OVER) / (UNDER + OVER) of n + m at most
    fits = (OVER * F.col("x.n") <= UNDER * F.col("y.n")) & (OVER * F.col("y.n") <= UNDER * F.col("x.n")) & ((UNDER + OVER) * differ <= (UNDER - OVER) * (F.col("x.n") + F.col("y.n")))
    apart = F.col("x.label") != F.col("y.label")
    central = F.max(F.struct("rank", (-F.col("rep")).alias("back"), "rep", "n", "label", "sketch"))
    first = F.min(F.struct("rep", "n", "label", "sketch"))
    done = labels = None
    for leader in (central, first, None):
        rows = lists.withColumn("label", F.col("rep")) if labels is None else lists.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        chosen = F.max_by(F.struct("label"), F.struct("rank", -F.col("rep"))) if leader is None else leader
        open_lists = rows.groupBy("key").agg(chosen.alias("x"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select(F.col("key").alias("list"), "x")
        if leader is None:
            # two sets in different components aren't both in that of the leader; that with the lower number goes where both are outside
            outside = rows.join(open_lists, (F.col("key") == F.col("list")) & (F.col("label") != F.col("x.label"))).withColumn("main", F.col("x.label")).drop("x", "list")
            once = (F.col("y.label") == F.col("x.main")) | (F.col("x.rep") < F.col("y.rep"))
            earlier = F.array_min(F.array_intersect("x.few", "y.few")) < F.xxhash64("x.key")  # a list before this one that has both
            pairs = outside.alias("x").join(rows.alias("y"), (F.col("x.key") == F.col("y.key")) & apart & once & fits & ~F.coalesce(earlier, F.lit(False)))
        else:
            pairs = rows.alias("y").join(open_lists, (F.col("y.key") == F.col("list")) & apart & fits)
        pairs = stored(pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct())
        if done is not None:
            new = stored(pairs.join(done, ["a", "b"], "left_anti"))
            dropped(pairs)
            pairs = new
        if pairs.isEmpty():
            continue
        result = stored(compared(pairs, sets))
        dropped(pairs)
        done = result if done is None else done.union(result)
        labels = components(done.where("linked").select("a", "b"))
    return labels if labels is not None else lists.select(F.col("rep").alias("node"), F.col("rep").alias("label")).limit(0)


def similar(df: DataFrame, *, doc: str = "doc_id", text: str = "text", width: int = WORDS, buckets: int | None = None) -> DataFrame:
    """(doc, n_shingles, component_id) of each row: its n-grams, and the least id that chains of links (similarity 3/4 or more) reach.

    Words are lower-cased by A-Z and split at white space. A null text or one without words has no n-grams, and is linked with nothing; so is a row with a null id.
    Repeated rows are equal texts and link; rows of one id with different texts are taken for different texts. An empty table gives none.
    ``buckets``: of the count of n-grams; a bucket should hold some million of them.
    """
    found = _grouped(df, doc=doc, text=text, width=width, buckets=buckets)
    return found.select(F.col("doc").alias(doc), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _grouped(df: DataFrame, *, doc: str, text: str, width: int, buckets: int | None) -> DataFrame:
    """(doc, n, digest, component, cluster) of each row. Rows of one component have one cluster; components of one least id, which has several texts, have several."""
    spark = df.sparkSession
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = stored(profile(df, doc=doc, text=text, width=width, buckets=buckets))
    known = seen.where("candidate and doc is not null")
    least = known.groupBy("digest").agg(F.min("doc").alias("id"))
    first = least.groupBy("id").agg(F.min("digest").alias("first"))
    # a class is known by its least id; where several have the same, all but one by a hash
    extra = F.col("digest") != F.col("first")
    classes = stored(least.join(first, "id").select("digest", "id", extra.alias("extra"), F.when(extra, F.xxhash64("digest")).otherwise(F.col("id")).alias("rep")))
    sets = stored(sets_of(df, classes.select("rep", "id", "digest"), doc=doc, text=text, width=width))
    found = stored(prefixes(sets, buckets))
    lists = stored(postings(found, boundary(found)))  # sketches travel with their sets' list entries
    labels = stored(linked_components(lists, sets))
    dropped(sets, found, lists)
    named = classes.join(labels, classes["rep"] == labels["node"], "left").select("digest", "id", "extra", F.coalesce("label", "rep").alias("cluster"))
    if not classes.where("extra").isEmpty():
        named = stored(named)
        touched = named.where("extra").select("cluster").distinct()
        true = named.join(touched, "cluster", "left_semi").groupBy("cluster").agg(F.min("id").alias("least id"))
        named = named.join(true, "cluster", "left").select("digest", F.coalesce("least id", "cluster").alias("component"), "cluster")
    else:
        named = named.select("digest", F.col("cluster").alias("component"), "cluster")
    rest = seen.where("not candidate or doc is null").withColumn("digest", F.coalesce("digest", F.lit(bytearray()))).select("doc", "n", "digest", F.col("doc").alias("component"), F.xxhash64("digest").alias("cluster"))
    joined = known.join(named, "digest").select("doc", "n", "digest", "component", "cluster")
    return joined.union(rest)


def first_of_each(df: DataFrame, *, doc: str = "doc_id", text: str = "text", width: int = WORDS, buckets: int | None = None) -> DataFrame:
    """The rows of ``df`` whose id is their component's, once for each id and component: one document of each group of near copies stays, and all rows without an id."""
    found = stored(_grouped(df, doc=doc, text=text, width=width, buckets=buckets).where("doc is not null"))
    ids = stored(found.groupBy("doc").agg(F.bool_or(F.col("component") == F.col("doc")).alias("kept"), (F.min("digest") == F.max("digest")).alias("single")).where("kept"))
    once = ids.where("single").select(F.col("doc").alias("kept id"))
    own = df.join(once, F.col(f"`{doc}`") == F.col("kept id")).drop("kept id").dropDuplicates([doc])
    several = ids.where("not single").select(F.col("doc").alias("kept id"))
    if not several.isEmpty():

        def digests(texts: pa.Array) -> list[pa.Array]:
            grams, sizes = shingle_sets(texts, width)
            return [pa.array([_digest(grams[e - s : e]) if s else b"" for s, e in zip(sizes, np.cumsum(sizes), strict=True)], pa.binary())]

        rows = append_columns(df.join(several, F.col(f"`{doc}`") == F.col("kept id")), text, digests, [T.StructField("kept digest", T.BinaryType())], [*df.columns, "kept id"])
        kept = found.where("component = doc").join(several, F.col("doc") == F.col("kept id"), "left_semi").groupBy(F.col("doc").alias("kept id"), "cluster").agg(F.min("digest").alias("kept digest")).drop("cluster")
        own = own.unionByName(rows.join(kept, ["kept id", "kept digest"]).dropDuplicates(["kept id", "kept digest"]).drop("kept id", "kept digest"))
    return own.unionByName(df.where(F.col(f"`{doc}`").isNull()))
