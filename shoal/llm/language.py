"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of its labelled text.  A text is parsed against it from left to right into the longest
phrases that occur there; few phrases mean that the text is like the labelled text.  The language with the fewest phrases,
each weighed by the logarithm of the size of what it is found in, wins.

Edges of an automaton lie in a hash table, so that it takes as much memory as its text is long, whatever the number of letters; where that is
little for all languages together, tasks spread it to a table by state and letter, which gives the same and is faster.  A long text is
parsed as a whole, but not from one end to the other: pieces of it start at once, all pieces of a slice advance by a letter at a time, and the parse
of each goes on into the next piece until it comes to a place where that one began a phrase too.  From there on both are the same.
"""

from __future__ import annotations

import math
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.arrowtext import append_columns
from shoal.llm.sampling import hash_bound

#: Documents of labelled text that are learned per language, and characters of each.
DOCUMENTS, SNIPPET = 300, 160
#: Letters of a piece.
PIECE = 256
#: Bytes of the tables of all languages by state and letter; more stay hash tables.
TABLE_BYTES = 100_000_000
UNDETERMINED = "und"

RESULT = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("phrases", T.LongType())]
_SPREAD = np.int64(0x1E3779B97F4A7C15)


def letters_of(text: str) -> str:
    """Lower-cased letters, with one space for whatever is between them."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class Automaton:
    """A suffix automaton: next state by state and symbol. The last state has no edges: a letter that the language doesn't have leads there. States are numbered in steps of ``width``."""

    def __init__(self, codes: list[int], width: int):
        follow = suffix_automaton(codes)
        self.size, self.width, self.nowhere = len(codes), width, len(follow) * width
        state = width * np.repeat(np.arange(len(follow)), [len(edges) for edges in follow])
        code = np.fromiter((c for edges in follow for c in edges), np.int64, len(state))
        to = width * np.fromiter((t for edges in follow for t in edges.values()), np.int64, len(state))
        self.table: np.ndarray | None = None
        self.start = np.full(width, self.nowhere, np.int64)
        self.start[code[state == 0]] = to[state == 0]
        keys = state + code
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = 62 - bits, (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        place, left = self._place(keys), np.arange(len(keys))
        while len(left):  # each takes the first free slot from its own on
            at, first = np.unique(place[left], return_index=True)
            free = self.keys[at] < 0
            self.keys[at[free]], self.to[at[free]] = keys[left[first[free]]], to[left[first[free]]]
            left = np.delete(left, first[free])
            place[left] = (place[left] + 1) & self.mask

    def _place(self, keys):
        return keys * _SPREAD >> self.shift & self.mask

    def table_bytes(self) -> int:
        return 4 * (self.nowhere + self.width)

    def spread(self) -> None:
        """Makes the table by state and letter; without an edge it has the complement of the state where the next phrase begins."""
        self.table = np.tile(~self.start, self.nowhere // self.width + 1).astype(np.int32)
        used = self.keys >= 0
        self.table[self.keys[used]] = self.to[used]

    def next(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, and which of them begin a phrase as there was no edge."""
        keys = state + code
        if self.table is not None:
            to = self.table.take(keys)
            lost = np.flatnonzero(to < 0)
            to[lost] = ~to[lost]
            return to, lost
        place = self._place(keys)
        found = self.keys.take(place)
        to = self.to.take(place)
        more = lost = np.flatnonzero(found != keys)
        to[lost] = -1
        while len(more):
            more = more[self.keys.take(place.take(more)) >= 0]
            place[more] = (place[more] + 1) & self.mask
            hit = self.keys.take(place.take(more)) == keys.take(more)
            to[more[hit]] = self.to[place[more[hit]]]
            more = more[~hit]
        lost = lost[to.take(lost) < 0]
        to[lost] = self.start.take(code.take(lost))
        return to, lost

    def parse(self, state: int, codes: memoryview, begins: memoryview, at: int, end: int) -> tuple[int, int]:
        """Phrases that begin in a range, letter by letter, up to the first place where one is marked; and that place."""
        n, keys, to, start = 0, memoryview(self.keys), memoryview(self.to), memoryview(self.start)
        spread, shift, mask = int(_SPREAD), self.shift, self.mask
        for at in range(at, end):
            c = codes[at]
            key = state + c
            place = key * spread >> shift & mask
            while (found := keys[place]) != key and found >= 0:
                place = (place + 1) & mask
            if found == key:
                state = to[place]
                continue
            if begins[at]:
                return n, at
            n, state = n + 1, start[c]
        return n, end


@dataclass
class Model:
    languages: list[str]
    symbols: np.ndarray  # by code point; 0 is a space or other character between letters, 1 a letter that no language has
    automata: list[Automaton]


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """The edges of each state of the suffix automaton of a sequence; its state 0 is the start."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return follow


def train(texts: dict[str, list[str]]) -> Model:
    """A model of the labelled texts of each language that has letters. It takes about 100 bytes a letter of them."""
    joined = {k: " ".join(filter(None, map(letters_of, v))) for k, v in sorted(texts.items())}
    joined = {k: v for k, v in joined.items() if v}
    known = {c: i + 2 for i, c in enumerate(sorted(set().union(*joined.values()) - {" "}))}
    symbols = np.zeros(0x110000, np.int32)
    for point in range(0x110000):
        c = chr(point)
        if unicodedata.category(c)[0] == "L":
            symbols[point] = known.get(c.lower()[0], 1)
    return Model(list(joined), symbols, [Automaton([0 if c == " " else known[c] for c in v], len(known) + 2) for v in joined.values()])


def sample(df: DataFrame, *, doc: str, text: str, lang: str, where: Column, documents: int = DOCUMENTS) -> dict[str, list[str]]:
    """Labelled snippets, from the middle of texts: for each language those documents whose hashed ids are least, ``documents`` at most (fewer where rows of one id are many).

    Every labelled language is learned, and each snippet. Rows with a null id, language or text aren't; of several texts of an id one is.
    Texts aren't shuffled: ids are chosen first, and then their texts are read. Only ids below a bound on their hashes, that follows from
    the language's number of rows, are shuffled: some hundred a language at any size.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    rows = df.where(where & F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{doc}`").alias("d"), F.col(f"`{lang}`").cast("string").alias("l")).where("d is not null")
    counted = rows.groupBy("l").count().collect()  # a row for each language
    bounds = spark.createDataFrame([(r["l"], hash_bound(documents, r["count"])) for r in counted], "l string, most bigint")
    low = rows.join(F.broadcast(bounds), "l").where(F.xxhash64("d") <= F.col("most")).select("d", "l")
    order = Window.partitionBy("l").orderBy(F.xxhash64("d"), "d")
    chosen = low.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= documents).select("d", "l")
    # at most ``documents`` ids a language
    ids = F.broadcast(chosen)
    own = df.select(F.col(f"`{doc}`").alias("d"), F.col(f"`{lang}`").cast("string").alias("l"), F.col(f"`{text}`").cast("string").alias("t"))
    middle = F.greatest(F.lit(1), (F.length("t") / 2).cast("int") - SNIPPET // 2)
    found = own.join(ids, ["d", "l"]).select("d", "l", F.substring("t", middle, F.lit(SNIPPET)).alias("t")).dropna().dropDuplicates(["d", "l"])
    out: dict[str, list[str]] = {}
    for r in found.orderBy("l", "d").collect():
        out.setdefault(r["l"], []).append(r["t"])
    return out


def phrase_counts(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of each text by language, and its number of letters."""
    strings = texts.fill_null("").to_pylist()
    points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    rows = np.repeat(np.arange(len(strings)), np.fromiter(map(len, strings), np.int64, len(strings)))
    codes = model.symbols[points]
    letters = np.bincount(rows[codes > 0], minlength=len(strings))
    # one space for what is between letters, none at the start of a text
    keep = codes > 0
    if len(codes):
        keep[1:] |= (codes[:-1] > 0) & (rows[1:] == rows[:-1])
    codes, rows = codes[keep].astype(np.int64), rows[keep]
    if len(codes):
        keep = codes > 0
        keep[:-1] |= rows[1:] == rows[:-1]  # nor at its end
        codes, rows = codes[keep], rows[keep]
    counts = np.zeros((len(strings), len(model.languages)), np.int64)
    if not len(codes):
        return counts, letters
    size = np.bincount(rows, minlength=len(strings))
    first = np.cumsum(size) - size
    pieces = -(-size // PIECE)
    owner = np.repeat(np.arange(len(strings)), pieces)
    start = first[owner] + PIECE * (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    end = np.minimum(start + PIECE, first[owner] + size[owner])
    order = np.argsort(start - end, kind="stable")
    active = np.searchsorted(start[order] - end[order], -np.arange(PIECE), "left")  # pieces longer than each step
    starts = start[order]
    if sum(a.table_bytes() for a in model.automata) <= TABLE_BYTES:
        for automaton in model.automata:
            if automaton.table is None:
                automaton.spread()
    follows = np.flatnonzero(owner[1:] == owner[:-1]) + 1  # pieces that go on with a text
    for k, automaton in enumerate(model.automata):
        begins = np.zeros(len(codes), bool)  # whether a phrase of its piece begins at a letter
        state = np.full(len(owner), automaton.nowhere, np.int64)  # in the order of lengths
        for step in range(PIECE):
            n = active[step]
            if not n:
                break
            at = starts[:n] + step
            state[:n], lost = automaton.next(state[:n], codes.take(at))
            begins[at[lost]] = True
        ended = np.empty_like(state)
        ended[order] = state
        more, meet = np.zeros(len(owner), np.int64), end.copy()  # phrases that the piece before begins here, and where they meet this one's
        on, state, step = follows, ended[follows - 1], 0
        while len(on):
            at = start[on] + step
            state, lost = automaton.next(state, codes[at])
            both = lost[begins[at[lost]]]
            meet[on[both]] = at[both]
            more[on[lost]] += 1
            more[on[both]] -= 1
            step += 1
            going = at + 1 < end[on]
            going[both] = False
            on, state = on[going], state[going]
        upto = np.concatenate([[0], np.cumsum(begins)])
        meet[owner != np.concatenate([[-1], owner[:-1]])] = start[owner != np.concatenate([[-1], owner[:-1]])]
        counts[:, k] = np.bincount(owner, weights=more + upto[end] - upto[meet], minlength=len(strings)).astype(np.int64)
        # a parse that passes a whole piece: what goes on from there isn't the piece's own, so such texts are put together from piece to piece
        passes = np.zeros(len(owner) + 1, bool)
        passes[follows] = (meet[follows] == end[follows]) & (end[follows] < first[owner[follows]] + size[owner[follows]])
        views = memoryview(codes), memoryview(begins)
        for row in np.unique(owner[np.flatnonzero(passes)]).tolist():
            j, stop = int(np.searchsorted(owner, row)), int(first[row] + size[row])
            last, total = j + int(pieces[row]) - 1, int(upto[end[j]] - upto[start[j]])
            while j < last:
                if passes[j + 1]:
                    n, at = automaton.parse(int(ended[j]), *views, int(start[j + 1]), stop)
                    j = (at - int(first[row])) // PIECE + int(np.searchsorted(owner, row)) if at < stop else last + 1
                    total += n + (int(upto[end[j]] - upto[at]) if j <= last else 0)
                else:
                    j += 1
                    total += int(more[j] + upto[end[j]] - upto[meet[j]])
            counts[row, k] = total
    return counts, letters


def identify(df: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``phrases`` (of that language) of every whole text.

    A null text or one without letters is ``und`` with score 0; so is every text if no language was learned. Of languages with equal
    values the first by name is taken. The score is 1 where no other language comes near, 0 where the next has as few phrases.
    Repeated rows are parsed each; an empty table gives no rows. ``keep``: the columns that stay, all by default; one that is named as a result gives way to it.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # as large as the labelled sample

    def compute(texts: pa.Array) -> list[pa.Array]:
        model = shared.value
        if not model.languages:
            return [pa.array([UNDETERMINED] * len(texts), pa.string()), pa.array([0.0] * len(texts), pa.float64()), pa.array([0] * len(texts), pa.int64())]
        counts, letters = phrase_counts(model, texts)
        cost = counts * np.array([math.log2(max(a.size, 2)) for a in model.automata])
        best = np.argmin(cost, axis=1)
        least = cost[np.arange(len(best)), best]
        rest = cost.copy()
        rest[np.arange(len(best)), best] = np.inf
        second = rest.min(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(np.isinf(second), 1.0, 1 - least / second)
        none = letters == 0
        score[none] = 0
        names = np.array(model.languages, object)[best]
        names[none] = UNDETERMINED
        return [pa.array(names, pa.string()), pa.array(np.clip(np.nan_to_num(score), 0, 1), pa.float64()), pa.array(np.where(none, 0, counts[np.arange(len(best)), best]), pa.int64())]

    return append_columns(df, text, compute, RESULT, df.columns if keep is None else keep)
