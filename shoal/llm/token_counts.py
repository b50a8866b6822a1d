"""Token counts under a unigram vocabulary, by dynamic programming over a trie of the distinct pre-tokens.

The forward score of a place in a word is the best sum of piece scores that spell its beginning.  Words with a common beginning share those
scores: a bucket's distinct words are put in a trie, scores are worked out once for each of its nodes, and a word's count is read
at its last node.  Words go to buckets by their first bytes, just so many that there are far more beginnings than buckets: so words with a longer
common beginning meet in one bucket, whatever the number of buckets, and its scores are worked out once for the corpus.  Counts come back to the
texts by the exchange of distinct words in ``wordblocks``.

Scores are a parameter. No public file at hand has those of a unigram model, and tokenizers aren't trained here, so the registered query derives them from a public order of ranks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.wordblocks import word_values


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Log probabilities of the pieces of a rank file: its order stands for frequency, by Zipf's law."""
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}


def count_tokens(words: list[str], scores: dict[bytes, float]) -> list[int]:
    """Pieces of the best segmentation of each word's bytes; of equal sums that with fewer pieces. A byte that no piece has counts as one piece.

    The sorted words are the trie walked in depth-first order: the scores of the beginning that a word shares with the one
    before are kept, only further nodes are worked out.
    """
    pieces = {p for p in scores if p}
    longest = max(map(len, pieces), default=1)
    lonely = min(scores.values(), default=0.0) - 10.0
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    out = [0] * len(words)
    path: list[tuple[float, int]] = [(0.0, 0)]  # by node from the root: best sum, and minus its pieces
    before = b""
    get = scores.get
    for i in sorted(range(len(raw)), key=raw.__getitem__):
        word = raw[i]
        common, most = 0, min(len(word), len(before))
        while common < most and word[common] == before[common]:
            common += 1
        del path[common + 1 :]
        for end in range(common + 1, len(word) + 1):
            best = (path[end - 1][0] + get(word[end - 1 : end], lonely), path[end - 1][1] - 1)
            for start in range(max(0, end - longest), end - 1):
                score = get(word[start:end])
                if score is not None:
                    best = max(best, (path[start][0] + score, path[start][1] - 1))
            path.append(best)
        out[i] = -path[-1][1]
        before = word
    return out


def beginning(buckets: int) -> int:
    """Bytes of a word that decide its bucket: so many that there are some 16 beginnings a bucket, at 16 that go on from each."""
    size, found = 1, 1
    while found < 16 * buckets:
        size, found = size + 1, 16 * found
    return size


def token_counts(df: DataFrame, scores: dict[bytes, float], pattern: str, *, doc: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """(doc, n_words, n_tokens) of each row: pre-tokens of its whole text, and their pieces.

    A null or empty text has none; repeated rows are counted each, rows without an id too; an empty table gives no rows. Other columns are left out.
    """
    buckets = buckets or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = beginning(buckets)
    shared = df.sparkSession.sparkContext.broadcast(scores)  # a vocabulary: of fixed size

    def work(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return np.ones(len(words), np.int64), np.array(count_tokens(words, shared.value), np.int64)

    def finish(docs: list[int], counts: np.ndarray, place: np.ndarray, values: np.ndarray, offsets: np.ndarray) -> pa.Table:
        total = np.r_[0, np.cumsum(values[place])]
        ends = np.cumsum(counts)
        return pa.table([pa.array(docs, pa.int64()), pa.array(counts), pa.array(total[ends] - total[ends - counts])], names=["doc", "n_words", "n_tokens"])

    found = word_values(df, doc, text, pattern, work, finish, "doc bigint, n_words bigint, n_tokens bigint", buckets, lambda word: word[:first])
    return found.select(F.col("doc").alias(doc), "n_words", "n_tokens")
