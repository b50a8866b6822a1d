"""Each stage on its own input, against plain versions."""

import public_tokenizers
import tiktoken

import corpus_pipeline as P
from shoal.llm import bpe
from shoal.llm.storage import stored
from tests.llm import brute


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    results = []
    for name, stage in P.STAGES:
        after = stored(stage(spark, docs, sf))
        results.append((name, [r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()]))
        if name != P.STAGES[-1][0]:
            assert after.columns == columns
        docs = after
    by = {name: (a, b) for name, a, b in results}
    before, after = by["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in after}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in ids for d in good) >= 0.95 * len(good)
    assert sum(d in ids for d, q in labels.items() if q == 0) <= 0.1 * len(labels)
    before, after = by["near_duplicates"]
    want = brute.similar([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, (_, c) in want.items() if d == c)
    before, after = by["benchmark"]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = brute.contamination([(r["doc_id"], r["text"]) for r in before], bench)
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, x in want.items() if not x[-1])
    before, after = by["secrets"]
    assert len(before) == len(after)
    assert all(brute.base_secrets(r["text"])[2] == 0 and r["n_chars"] == len(r["text"]) for r in after)
    before, after = by["tokens"]
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = {r["doc_id"]: r["text"] for r in before}
    assert len(after) == len(want)
    for r in after:
        assert r["ids"] == enc.encode_ordinary(want[r["doc_id"]]) and r["n_tokens"] == len(r["ids"]) and r["decoded_sha256"] == brute.sha(want[r["doc_id"]])


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_stages_on_awkward_rows(spark):
    """Nulls in any column, empty and very long texts, repeated rows, one id with several texts, and columns named as helpers are."""
    sf = "/root/testdata/sf0.001"
    long = " ".join(f"word{i % 5000} of text {i % 7}" for i in range(60_000))
    good = spark.read.parquet(f"{sf}/documents.parquet").limit(6).collect()
    texts = [None, "", "  ", long, "a b", *[r.text for r in good]]
    made = [(i, t, None if i % 2 else "en", None if i % 3 else "src", None, "x", 1.0, "k") for i, t in enumerate(texts)]
    made += [made[-1], made[-1], (made[-1][0], "another text of the id " * 20, "en", "src", 5, None, None, None), (None, good[0].text, "en", "src", 7, "x", 1.0, "k"), (None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long, rep string, score double, key string").repartition(3)
    for name, stage in P.STAGES:
        own, none = stored(stage(spark, docs, sf)), stage(spark, docs.limit(0), sf)
        assert none.columns == own.columns and none.isEmpty()
        if name != "tokens":
            assert own.columns == docs.columns
        if name == "secrets":
            assert own.count() == docs.count()
        elif name == "tokens":
            assert own.count() == docs.count() and own.where("doc_id is null").count() == 2
        elif name == "near_duplicates":
            kept = [(r.doc_id, r.text) for r in own.collect()]
            assert (10, "another text of the id " * 20) in kept and kept.count((10, texts[10])) == 1 and sum(d is None for d, _ in kept) == 2
            assert not set(rows(own)) - set(rows(docs))
        else:
            assert not set(rows(own)) - set(rows(docs))
